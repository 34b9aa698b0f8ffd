"""The registered workload: one query per operator, over the given tables.

Each function takes (spark, sf_dir) and returns a DataFrame; the index it
searches is built from the tables under sf_dir (once per process and set of
source files, then reused), so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import Analyzer, tokens
from quarry.operators import analysis, batch
from quarry.plans.index import Index
from quarry.plans.searcher import Searcher
from quarry.query import (Equals, Fuzzy, Phrase, Prefix, Range, Term, all_of, any_of,
                          any_words, boolean, match)
from quarry.schema import Schema
from quarry.querystring import parse
from quarry.session import checkpoint_dir, scratch_path, source_key
from quarry.sources.corpus import COMMIT_COL, ingest

DOCS_SCHEMA = (Schema()
               .add_text_field("text", stored=True)
               .add_text_field("lang", stored=True)
               .add_text_field("source")                 # searchable, never returned
               .add_u64_field("n_chars", stored=True)
               .add_u64_field("quality", stored=True)
               .add_bool_field("toxic", stored=True))

PART_SCHEMA = (Schema()
               .add_text_field("p_name", stored=True)
               .add_text_field("p_brand", stored=True)
               .add_text_field("p_type", stored=True)
               .add_u64_field("p_size", stored=True)
               .add_f64_field("p_retailprice", stored=True))

CUSTOMER_SCHEMA = (Schema()
                   .add_text_field("c_name", stored=True)
                   .add_text_field("c_mktsegment", stored=True)
                   .add_i64_field("balance", stored=True)
                   .add_u64_field("big", stored=True)        # above the signed range
                   .add_f64_field("c_acctbal", stored=True))

EVENTS_SCHEMA = (Schema()
                 .add_text_field("event_type", stored=True)
                 .add_text_field("props", stored=True, indexed=False)
                 .add_u64_field("user_id", stored=True)
                 .add_f64_field("value", stored=True))

TURNS_SCHEMA = (Schema()
                .add_text_field("role", stored=True)
                .add_text_field("text", stored=True))

PAGES_SCHEMA = (Schema()
                .add_text_field("html", stored=True)
                .add_text_field("url", stored=True, indexed=False))

# the append / snapshot queries write this many commits, by the id
COMMITS = 3

_BUILT: dict[tuple, str] = {}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def docs_frame(spark, sf) -> DataFrame:
    labels = _t(spark, sf, "labels").select(
        "doc_id", "quality", (F.col("toxic") == 1).alias("toxic"))
    return _t(spark, sf, "documents").join(labels, "doc_id", "left")


def _built(spark, name: str, make, *sources: DataFrame) -> Index:
    """The index `make(path)` writes, once for each state of the source files."""
    key = (name, checkpoint_dir(spark), *[source_key(d) for d in sources])
    if key not in _BUILT:
        path = scratch_path(spark, name)
        make(path)
        _BUILT[key] = path
    return Index.open(spark, _BUILT[key])


def _index(spark, sf, table: str, schema: Schema, df: DataFrame, id_col: str, **kept: bool) -> Index:
    return _built(spark, table, lambda path: Index.build(df, schema, id_col, path, **kept), df)


def docs_index(spark, sf) -> Index:
    return _index(spark, sf, "documents", DOCS_SCHEMA, docs_frame(spark, sf), "doc_id", near=True, pairs=True)


def part_index(spark, sf) -> Index:
    return _index(spark, sf, "part", PART_SCHEMA, _t(spark, sf, "part"), "p_partkey")


def customer_index(spark, sf) -> Index:
    c = _t(spark, sf, "customer").withColumns({
        "balance": F.floor("c_acctbal").cast("long"),
        "big": F.col("c_custkey").cast("decimal(20,0)") + F.lit(str(2 ** 63)).cast("decimal(20,0)")})
    return _index(spark, sf, "customer", CUSTOMER_SCHEMA, c, "c_custkey")


def events_index(spark, sf) -> Index:
    return _index(spark, sf, "events", EVENTS_SCHEMA, _t(spark, sf, "events"), "event_id")


def turns_index(spark, sf) -> Index:
    """A conversation turn is one document."""
    t = _t(spark, sf, "conversations").withColumn("doc_id", F.concat_ws(":", "conv_id", "turn"))
    return _index(spark, sf, "conversations", TURNS_SCHEMA, t, "doc_id")


def pages_index(spark, sf) -> Index:
    return _index(spark, sf, "pages", PAGES_SCHEMA, _t(spark, sf, "pages"), "page_id")


def _scored(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.round("score", 6).alias("score"))


def _hits(index_fn, query):
    def run(spark, sf):
        return _scored(Searcher(index_fn(spark, sf)).hits(query))
    return run


def _string_hits(index_fn, fields, text):
    def run(spark, sf):
        idx = index_fn(spark, sf)
        return _scored(Searcher(idx).hits(parse(idx.schema, fields, text)))
    return run


def _as_long(df: DataFrame, *cols: str) -> DataFrame:
    """Unsigned values that fit, as the plain integers of the source."""
    return df.withColumns({c: F.col(c).cast("long") for c in cols})


# ------------------------------------------------------------------ A: sources
def q_ingest_typed(spark, sf):
    c = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("doc_id"), "c_name", "c_acctbal", "c_nationkey",
        "c_mktsegment",
        F.floor("c_acctbal").cast("long").alias("balance_units"),
        F.floor("c_acctbal").cast("long").alias("balance_u"))
    schema = (Schema().add_text_field("c_name", stored=True)
              .add_f64_field("c_acctbal", stored=True)
              .add_u64_field("c_nationkey", stored=True)      # int -> widened
              .add_i64_field("balance_units", stored=True)
              .add_u64_field("balance_u", stored=True)        # negatives -> null
              .add_bool_field("c_mktsegment", stored=True)    # string -> null
              .add_text_field("c_phone", stored=True))        # missing -> null
    return _as_long(ingest(c, schema), "c_nationkey", "balance_u")


def q_corpus_scan(spark, sf):
    return _as_long(docs_index(spark, sf).corpus.select(
        "doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"), "n_chars", "quality")


def _committed_index(spark, sf) -> Index:
    """`documents` written as COMMITS commits, a document's by its id."""
    docs = docs_frame(spark, sf)

    def make(path):
        idx = None
        for c in range(COMMITS):
            part = docs.where(F.pmod("doc_id", F.lit(COMMITS)) == c)
            idx = idx.append(part, c) if idx else Index.build(part, DOCS_SCHEMA, path=path, commit_id=c)

    return _built(spark, "commits", make, docs)


def q_append_commit(spark, sf):
    return _as_long(_committed_index(spark, sf).corpus.select("doc_id", "lang", "n_chars", COMMIT_COL), "n_chars")


def q_snapshot_read(spark, sf):
    idx = _committed_index(spark, sf).as_of(1)
    return _scored(Searcher(idx).hits(Term("text", "the")))


def q_stream_ingest(spark, sf):
    """A folder that receives the documents in several files: each third of
    them is a micro-batch, and so a commit."""
    from quarry.streaming.ingest_stream import ingest_stream
    src = _t(spark, sf, "documents")
    folder, path = scratch_path(spark, "incoming"), scratch_path(spark, "stream")
    files = max(COMMITS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    src.repartition(files, "doc_id").write.parquet(folder)
    sdf = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", -(-files // COMMITS)).parquet(folder)
    ingest_stream(spark, sdf, Schema().add_text_field("text", stored=True), path)
    return Index.open(spark, path).terms.select(
        "doc_id", "field", "term", F.col("tf").cast("long").alias("tf"))


# ------------------------------------------------------------------ B: analysis
def q_tokenise(spark, sf):
    d = _t(spark, sf, "documents")
    toks = tokens("text")
    return d.select("doc_id", F.size(toks).cast("long").alias("n_tokens"),
                    F.array_join(toks, " ").alias("tokens"))


def q_postings(spark, sf):
    return analysis.postings(_t(spark, sf, "documents"), ["text"]).select(
        "doc_id", "field", F.col("pos").cast("long").alias("pos"), "term")


def q_term_stats(spark, sf):
    """Per (field, term, document): tf and length; per term: df, cf, idf."""
    from quarry.operators.scoring import idf
    idx = docs_index(spark, sf)
    n, _ = idx.stat_columns()
    rows = idx.terms.join(idx.vocabulary(), ["field", "term"])
    return rows.select("field", "term", "doc_id", F.col("tf").cast("long").alias("tf"),
                       F.col("dl").cast("long").alias("dl"), "df", "cf",
                       F.round(idf(F.col("df"), n), 6).alias("idf"))


def q_vocabulary(spark, sf):
    return docs_index(spark, sf).vocabulary().select("field", "term", "df", "cf")


def q_corpus_stats(spark, sf):
    return docs_index(spark, sf).stats().select(
        "field", "n_docs", "total_len", F.round("avgdl", 6).alias("avgdl"))


# ------------------------------------------------------------------ C: predicates
q_term_match = _hits(docs_index, Term("text", "the"))
q_field_term = _hits(part_index, match("p_name", "RED"))
q_field_phrase = _hits(docs_index, match("text", "In THE"))
q_prefix_match = _hits(docs_index, Prefix("text", "men"))
q_fuzzy_match = _hits(docs_index, Fuzzy("text", "thier", 1))
q_fuzzy_plain = _hits(docs_index, Fuzzy("text", "oratnion", 2, transposition=False))
q_fuzzy_swaps_k2 = _hits(docs_index, Fuzzy("text", "oratnion", 2, transposition=True))
q_fuzzy_prefix = _hits(docs_index, Fuzzy("text", "mnt", 1, prefix=True))
q_phrase_match = _hits(docs_index, Phrase("text", ["of", "the"]))
q_range_u64 = _hits(docs_index, Range("n_chars", 100, 1000, "both", "u64"))
q_range_i64 = _hits(customer_index, Range("balance", -500, 500, "lower", "i64"))
q_range_f64 = _hits(events_index, Range("value", 10.0, 50.0, "neither", "f64"))
q_range_u64_high = _hits(customer_index, Range("big", 2 ** 63 + 100, 2 ** 64 - 1, "both", "u64"))
q_range_open = _hits(docs_index, Range("n_chars", 1000, None))
q_field_equals = _hits(docs_index, Equals("toxic", True))

# ------------------------------------------------------------------ D: boolean
q_bool_and = _hits(docs_index, all_of(Term("text", "de"), Term("text", "la")))
q_bool_or = _hits(docs_index, any_of(Term("text", "und"), Term("text", "y")))
q_bool_default_or = _hits(docs_index, any_words(["text"], "Der die DAS"))
q_bool_must_should = _hits(docs_index, boolean(must=[Term("text", "the")],
                                               should=[Term("text", "of")]))
q_bool_must_not = _hits(docs_index, boolean(must=[Term("text", "the")],
                                            must_not=[Term("text", "and")]))
q_bool_nested = _hits(docs_index, all_of(Term("text", "de"),
                                         any_of(Term("text", "la"), Term("text", "le"))))
q_field_group = _hits(part_index, any_of(Term("p_name", "red"), Term("p_name", "blue")))
q_multi_field = _hits(part_index, any_words(["p_name", "p_type"], "small widget"))
q_multi_field_turns = _hits(turns_index, any_words(["role", "text"], "assistant la"))
q_text_and_range = _hits(docs_index, all_of(Term("text", "the"), Range("n_chars", 1000, 5000)))
q_phrase_and_term = _hits(docs_index, boolean(must=[Phrase("text", ["of", "the"])],
                                              must_not=[Term("text", "and")]))


# query strings
q_query_string_nested = _string_hits(
    docs_index, ["text"], '+the (text:of OR "in the") -and')
q_query_string_range = _string_hits(
    docs_index, ["text"], "the AND (n_chars:[1000 TO 5000} OR toxic:true)")
q_query_string_not = _string_hits(docs_index, ["text"], 'the of AND NOT and NOT "in the"')
q_query_string_signed = _string_hits(customer_index, ["c_name"], "balance:-5 OR balance:[-900 TO -800} OR balance:+42")


def grams_index(spark, sf) -> Index:
    """Part names by the 3-grams of their words, part types without frequent words."""
    schema = (Schema().add_text_field("p_name", analyzer=Analyzer(grams=3))
              .add_text_field("p_type", analyzer=Analyzer("spaces", stop=("small", "large"))))
    return _index(spark, sf, "part-grams", schema, _t(spark, sf, "part"), "p_partkey")


def q_analyzer_grams(spark, sf):
    """Names with an inner string, found by its n-grams."""
    idx = grams_index(spark, sf)
    return Searcher(idx).hits(parse(idx.schema, ["p_name"], "idge OR p_type:SMALL")).select("doc_id")


# ------------------------------------------------------------------ E: ranking
q_bm25_score = _hits(docs_index, any_words(["text"], "the language of data"))
q_constant_score = _hits(docs_index, any_of(Prefix("text", "lang"), Range("n_chars", 0, 100)))


def q_top_k(spark, sf):
    s = Searcher(docs_index(spark, sf))
    return _scored(s.search(any_words(["text"], "the language of data"), 10, stored=False))


def q_total_hits(spark, sf):
    return Searcher(docs_index(spark, sf)).total_hits(Term("text", "de"), 10)


def q_stored_fields(spark, sf):
    s = Searcher(docs_index(spark, sf))
    r = s.search(any_words(["text"], "the language of data"), 10)
    return _as_long(r.select("doc_id", F.round("score", 6).alias("score"), "lang", "n_chars",
                             "quality", "toxic", "text"), "n_chars", "quality")


def q_facets(spark, sf):
    """Counts of hits by language, by label and by length."""
    s = Searcher(docs_index(spark, sf))
    return s.facets(any_words(["text"], "the language of data"), ["lang", "toxic", ("n_chars", [100, 1000, 5000])])


def q_facets_top(spark, sf):
    """The same over the best 100 hits."""
    s = Searcher(docs_index(spark, sf))
    return s.facets(any_words(["text"], "the language of data"), ["lang", ("n_chars", [100, 1000, 5000])], limit=100)


def q_sorted_hits(spark, sf):
    """Three pages of ten hits by length, longest first, each after the last row of the one before."""
    s = Searcher(docs_index(spark, sf))
    pages, after = [], None
    for _ in range(3):
        page = s.search_sorted(Term("text", "the"), "n_chars", descending=True, limit=10, after=after, stored=False)
        pages.append(page)
        after = s.cursor(page)
    rows = pages[0].unionByName(pages[1]).unionByName(pages[2])
    return rows.select("doc_id", F.col("value").cast("long").alias("value"), F.round("score", 6).alias("score"))


# ------------------------------------------------------------------ F: highlight
def q_snippets(spark, sf):
    s = Searcher(docs_index(spark, sf))
    r = s.search_with_snippets(any_words(["text"], "the language of data"), ["text"], 150, 10)
    return r.select("doc_id", F.round("score", 6).alias("score"),
                    F.col("snippets")["text"].alias("snippet"))


def q_fuzzy_snippets(spark, sf):
    s = Searcher(docs_index(spark, sf))
    r = s.search_fuzzy_with_snippets("text", "thier", ["text"], 1, True, 150, 10)
    return r.select("doc_id", F.round("score", 6).alias("score"),
                    F.col("snippets")["text"].alias("snippet"))


def q_snippets_html(spark, sf):
    """F1 on raw web pages: markup, entities and quotes must come back escaped."""
    s = Searcher(pages_index(spark, sf))
    r = s.search_with_snippets(any_words(["html"], "amp href nav"), ["html"], 150, 10)
    return r.select("doc_id", F.round("score", 6).alias("score"),
                    F.col("snippets")["html"].alias("snippet"))


# ------------------------------------------------------------------ G: many queries
def q_batch_search(spark, sf):
    idx = docs_index(spark, sf)
    qs = _t(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    r = batch.batch_search(idx, qs, "text", 10)
    return r.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id",
                    F.round("score", 6).alias("score"))


def query_strings(spark, sf) -> DataFrame:
    """A query string for each `benchmark` item, of its first words, in five forms."""
    words = tokens("text")
    w = [F.coalesce(F.get(words, F.lit(i)), F.lit("of")) for i in range(6)]
    form = F.pmod("item_id", F.lit(5))
    text = (F.when(form == 0, F.concat_ws(" ", *w))
             .when(form == 1, F.format_string('"%s %s" OR (+%s +%s)', *w[:4]))
             .when(form == 2, F.format_string("+%s %s NOT %s", *w[:3]))
             .when(form == 3, F.format_string("(%s OR %s) AND n_chars:[200 TO 3000]", *w[:2]))
             .otherwise(F.lit("the")))
    return _t(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), text.alias("text"))


def q_batch_query_strings(spark, sf):
    r = Searcher(docs_index(spark, sf)).batch_query_strings(query_strings(spark, sf), ["text"], 10)
    return r.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", F.round("score", 6).alias("score"))


def q_batch_fuzzy(spark, sf):
    idx = docs_index(spark, sf)
    words = _t(spark, sf, "benchmark").select(F.explode(tokens("text")).alias("word"))
    r = batch.batch_fuzzy(idx, words, "text", 1, True)
    return r.select("word", "term", F.col("distance").cast("long").alias("distance"))


QUERIES = {
    "ingest_typed": q_ingest_typed,
    "corpus_scan": q_corpus_scan,
    "append_commit": q_append_commit,
    "snapshot_read": q_snapshot_read,
    "stream_ingest": q_stream_ingest,
    "tokenise": q_tokenise,
    "postings": q_postings,
    "term_stats": q_term_stats,
    "vocabulary": q_vocabulary,
    "corpus_stats": q_corpus_stats,
    "term_match": q_term_match,
    "field_term": q_field_term,
    "field_phrase": q_field_phrase,
    "prefix_match": q_prefix_match,
    "fuzzy_match": q_fuzzy_match,
    "fuzzy_plain": q_fuzzy_plain,
    "fuzzy_swaps_k2": q_fuzzy_swaps_k2,
    "fuzzy_prefix": q_fuzzy_prefix,
    "phrase_match": q_phrase_match,
    "range_u64": q_range_u64,
    "range_i64": q_range_i64,
    "range_f64": q_range_f64,
    "range_u64_high": q_range_u64_high,
    "range_open": q_range_open,
    "field_equals": q_field_equals,
    "bool_and": q_bool_and,
    "bool_or": q_bool_or,
    "bool_default_or": q_bool_default_or,
    "bool_must_should": q_bool_must_should,
    "bool_must_not": q_bool_must_not,
    "bool_nested": q_bool_nested,
    "field_group": q_field_group,
    "multi_field": q_multi_field,
    "multi_field_turns": q_multi_field_turns,
    "text_and_range": q_text_and_range,
    "phrase_and_term": q_phrase_and_term,
    "query_string_nested": q_query_string_nested,
    "query_string_range": q_query_string_range,
    "query_string_not": q_query_string_not,
    "query_string_signed": q_query_string_signed,
    "analyzer_grams": q_analyzer_grams,
    "bm25_score": q_bm25_score,
    "constant_score": q_constant_score,
    "top_k": q_top_k,
    "total_hits": q_total_hits,
    "stored_fields": q_stored_fields,
    "facets": q_facets,
    "facets_top": q_facets_top,
    "sorted_hits": q_sorted_hits,
    "snippets": q_snippets,
    "fuzzy_snippets": q_fuzzy_snippets,
    "snippets_html": q_snippets_html,
    "batch_search": q_batch_search,
    "batch_fuzzy": q_batch_fuzzy,
    "batch_query_strings": q_batch_query_strings,
}

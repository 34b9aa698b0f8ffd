"""Postings, the term table, corpus statistics and the vocabulary.

Everything is derived with explode / groupBy on executors. The term table
has one row per (field, term, document): tf, the document's length in
that field, and the sorted positions. It is the inverted index: later
operators filter it on (field, term), which parquet can skip on when the
table is clustered by term.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import Analyzer, tokens
from quarry.operators.chunks import posting_rows
from quarry.operators.scoring import bm25_share
from quarry.schema import BOOL, F64, I64, U64, Field
from quarry.sources.corpus import COMMIT_COL

# A commit's documents in the order of their ids, so many to a block: a hidden
# column of the corpus and the term table, ascending with the id.
BLOCK_COL = "_block"
BLOCK_DOCS = 128
# A term in at least so many documents of a commit, and in this share of them
# (four of a block's), has its blocks' tops kept: a rarer one is in so few
# documents of a block that its tops would be as many as its rows.
FREQUENT, FREQUENT_SHARE = 4 * BLOCK_DOCS, 4 / BLOCK_DOCS
# Blocks of a partition of the corpus: its number is in the row number's bits above the 33rd.
RUN_BLOCKS = (1 << 33) // BLOCK_DOCS

# The column of the value table that holds a field type's values.
VALUE_COLUMNS = {U64: "dec", I64: "long", F64: "dbl", BOOL: "long"}
# Pairs of neighbouring words are kept if both are in this share of a commit's
# documents, and in this many.
PAIR_SHARE, PAIR_DOCS = 0.1, 100
# Common words up to this number are broadcast; more (documents of very many
# distinct words) are joined as any table.
BROADCAST_WORDS = 100_000
# Frequent words up to this number are a filter of the scan, which costs far less
# a row than a join with them does; more are joined.
FILTER_WORDS = 10_000
VALUE_TYPES = {"dec": "decimal(20,0)", "long": "long", "dbl": "double"}


def field_texts(corpus: DataFrame, fields: list[str], id_col: str = "doc_id") -> DataFrame:
    """(doc_id, [commit_id], field, text): one row per document and text field."""
    keys = [F.col(id_col).alias("doc_id")]
    keys += [F.col(c) for c in (COMMIT_COL, BLOCK_COL) if c in corpus.columns]
    if not fields:   # no indexed text field: an empty, typed table
        return corpus.select(*keys, F.lit(None).cast("string").alias("field"),
                             F.lit(None).cast("string").alias("text")).where(F.lit(False))
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("text"))
                      for f in fields])
    return corpus.select(*keys, F.inline(pairs))


def postings(corpus: DataFrame, fields: list[str], id_col: str = "doc_id") -> DataFrame:
    """Token table (doc_id, field, pos, term)."""
    ft = field_texts(corpus, fields, id_col)
    keys = [c for c in ft.columns if c in ("doc_id", COMMIT_COL, "field")]
    # posexplode_outer: no inferred `size(...) > 0` filter that would run the
    # regex a second time; the null row of an empty text is dropped after.
    return (ft.select(*keys, F.posexplode_outer(tokens("text")).alias("pos", "term"))
              .where(F.col("term").isNotNull()))


def _field_tokens(analyzers: dict[str, Analyzer]):
    """The tokens of (field, text) rows, by the field's own chain."""
    out = tokens("text")
    for f, a in sorted(analyzers.items()):
        out = F.when(F.col("field") == f, tokens("text", a)).otherwise(out)
    return out


def _token_arrays(corpus: DataFrame, fields: list[str], id_col: str, partitions: int | None,
                  analyzers: dict[str, Analyzer] | None):
    """(key columns, rows (keys, toks, dl) of the documents' fields, whether
    tokens may be gaps)."""
    if partitions:
        corpus = corpus.repartition(partitions, F.col(f"`{id_col}`"))
    ft = field_texts(corpus, fields, id_col)
    keys = [c for c in ft.columns if c in ("doc_id", COMMIT_COL, "field", BLOCK_COL)]
    # dl is computed once per document, below the explode; computed in the
    # same select as the generator it would be re-evaluated per token.
    grams = any(a.grams for a in (analyzers or {}).values())        # these leave gaps
    length = F.size(F.filter("toks", lambda t: t != "")) if grams else F.size("toks")
    toks = (ft.select(*keys, _field_tokens(analyzers or {}).alias("toks"))
              .select(*keys, "toks", length.alias("dl")))
    return keys, toks, grams


def common_words(vocab: DataFrame, n_docs: Column) -> Column:
    """Whether a vocabulary row's word is in so large a share of a commit's
    documents that its pairs are kept. A document of d distinct words has room
    for few of them: there are at most (mean d) / PAIR_SHARE in a field."""
    return (vocab["df"] >= F.lit(PAIR_SHARE) * n_docs) & (vocab["df"] >= PAIR_DOCS)


def _dealt(corpus: DataFrame, fields: list[str], id_col: str, partitions: int, analyzers: dict[str, Analyzer] | None,
           common: dict[str, list[str]] | None = None) -> DataFrame:
    def tokens_of(docs):
        return _token_arrays(docs, fields, id_col, None, analyzers)[1].withColumnRenamed(BLOCK_COL, "block")

    grams = any(a.grams for a in (analyzers or {}).values())
    return posting_rows(tokens_of, corpus, corpus.count(), partitions, RUN_BLOCKS, grams, common)


def pair_table(corpus: DataFrame, common: DataFrame, fields: list[str], id_col: str, partitions: int,
               analyzers: dict[str, Analyzer] | None = None) -> DataFrame:
    """(field, w1, w2, doc_id, dl, positions): where in a document two common
    words (`common`: field, term) stand next to each other, for a corpus of
    numbered rows with unique ids, in partitions that are ranges of (field, w1,
    w2, doc_id). The common words, which are counted first, are sent to the
    tasks if they are few; else tokens are joined with them."""
    if common.count() <= BROADCAST_WORDS:
        words: dict[str, list[str]] = {}
        for r in common.select("field", "term").collect():
            words.setdefault(r["field"], []).append(r["term"])
        return _dealt(corpus, fields, id_col, partitions, analyzers, words).drop("block", "tf")
    _, toks, _ = _token_arrays(corpus, fields, id_col, partitions, analyzers)
    near = F.transform(F.sequence(F.lit(0), F.size("toks") - 2), lambda i: F.struct(
        i.alias("pos"), F.get("toks", i).alias("w1"), F.get("toks", i + 1).alias("w2")))
    pairs = toks.where(F.size("toks") >= 2).select("doc_id", "field", "dl", F.inline(near))
    for w in ("w1", "w2"):
        words = common.select("field", F.col("term").alias(w))
        pairs = pairs.join(words, ["field", w], "left_semi")
    place = ["field", "w1", "w2", "doc_id"]
    return (pairs.groupBy("doc_id", "field", "w1", "w2").agg(
        F.any_value("dl").alias("dl"), F.array_sort(F.collect_list("pos")).alias("positions"))
        .repartitionByRange(partitions, *place).sortWithinPartitions(*place))


def dealt_terms(corpus: DataFrame, fields: list[str], id_col: str, partitions: int,
                analyzers: dict[str, Analyzer] | None = None) -> DataFrame:
    """The term table of a corpus of numbered rows with unique ids, in
    partitions that are ranges of (field, term, doc_id), sorted. A document's
    tokens are grouped where it is read, and dealt by the chunk (`chunks`)."""
    return _dealt(corpus, fields, id_col, partitions, analyzers).select(
        "field", "term", "doc_id", "dl", F.col("block").alias(BLOCK_COL), "tf", "positions")


def term_table(corpus: DataFrame, fields: list[str], id_col: str = "doc_id",
               analyzers: dict[str, Analyzer] | None = None) -> DataFrame:
    """(commit_id?, field, term, doc_id, tf, dl, positions).

    Document length is computed from the token array before the explode,
    so no join is needed to attach it.
    """
    keys, toks, grams = _token_arrays(corpus, fields, id_col, None, analyzers)
    block = [F.any_value(BLOCK_COL).alias(BLOCK_COL)] if BLOCK_COL in keys else []
    exploded = (toks.select(*keys, "dl", F.posexplode_outer("toks").alias("pos", "term"))
                    .where(F.col("term") != "" if grams else F.col("term").isNotNull()))
    # the term first: rows are sorted by the keys, and a term's first bytes
    # tell rows apart better than an id that a whole document shares
    group = [c for c in ("term", "doc_id", "field", COMMIT_COL) if c in exploded.columns]
    return exploded.groupBy(*group).agg(
        F.any_value("dl").alias("dl"), *block,
        F.count(F.lit(1)).cast("int").alias("tf"),
        F.array_sort(F.collect_list("pos")).alias("positions"),
    )


def value_table(corpus: DataFrame, fields: list[Field], id_col: str = "doc_id") -> DataFrame:
    """(field, dec, long, dbl, doc_id, commit_id?): one row per document and
    value that is not null; the field's type says which column holds it (a
    boolean as 0 or 1)."""
    keys = [F.col(f"`{id_col}`").alias("doc_id")] + [F.col(c) for c in corpus.columns if c == COMMIT_COL]
    parts = []
    for f in fields:
        mine = VALUE_COLUMNS[f.type]
        parts.append(corpus.where(F.col(f"`{f.name}`").isNotNull()).select(
            F.lit(f.name).alias("field"),
            *[(F.col(f"`{f.name}`") if c == mine else F.lit(None)).cast(t).alias(c) for c, t in VALUE_TYPES.items()], *keys))
    if not parts:
        nothing = [F.lit(None).cast(t).alias(c) for c, t in {"field": "string", **VALUE_TYPES}.items()]
        return corpus.select(*nothing, *keys).where(F.lit(False))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def vocabulary(terms: DataFrame) -> DataFrame:
    """(field, term, df, cf): distinct terms of each field with document and
    collection frequency. Summing per-commit rows gives the view's numbers."""
    if "df" in terms.columns:   # already a per-commit vocabulary
        return terms.groupBy("field", "term").agg(
            F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    return terms.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def commit_vocabulary(terms: DataFrame) -> DataFrame:
    """Per-commit vocabulary, the materialised form of `vocabulary`."""
    return terms.groupBy(COMMIT_COL, "field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def frequent_words(vocab: DataFrame, n_docs: Column) -> Column:
    """Whether a vocabulary row's term is in so many documents of a commit that
    its blocks' tops are kept. A document of d distinct words has room for few
    of them (d / FREQUENT_SHARE in a field), so that there is at most d / 4 of a top a
    document, however large the commit."""
    return (vocab["df"] >= FREQUENT) & (vocab["df"] >= F.lit(FREQUENT_SHARE) * n_docs)


def block_tops(terms: DataFrame, vocab: DataFrame, avgdl: dict[str, float], n_docs: int) -> DataFrame:
    """(field, term, _block, top): the largest share of idf * (k1 + 1) that a
    frequent term contributes to a document of each block, by the commit's own
    average lengths."""
    frequent = vocab.where(frequent_words(vocab, F.lit(n_docs))).select("field", "term")
    some = frequent.limit(FILTER_WORDS + 1).collect()
    if len(some) <= FILTER_WORDS:
        words: dict[str, list[str]] = {}
        for r in some:
            words.setdefault(r["field"], []).append(r["term"])
        own = terms.where(reduce(lambda x, y: x | y, [(F.col("field") == f) & F.col("term").isin(w) for f, w in sorted(words.items())], F.lit(False)))
    else:
        own = terms.join(F.broadcast(frequent) if frequent.count() <= BROADCAST_WORDS else frequent, ["field", "term"], "left_semi")
    mean = F.lit(1.0)
    for f, a in sorted(avgdl.items()):
        mean = F.when(F.col("field") == f, F.lit(float(a or 1.0))).otherwise(mean)
    share = bm25_share(F.col("tf"), F.col("dl"), mean)
    return own.groupBy("field", "term", BLOCK_COL).agg(F.max(share).alias("top"))


def commit_stats(corpus: DataFrame, terms: DataFrame, fields: list[str]) -> DataFrame:
    """(commit_id, field, n_docs, total_len): tiny, one row per commit and field."""
    docs = corpus.groupBy(COMMIT_COL).agg(F.count(F.lit(1)).alias("n_docs"))
    lens = terms.groupBy(COMMIT_COL, "field").agg(F.sum("tf").alias("total_len"))
    names = F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<string>")
    per_field = docs.select(COMMIT_COL, "n_docs", F.explode(names).alias("field"))
    return (per_field.join(lens, [COMMIT_COL, "field"], "left")
                     .select(COMMIT_COL, "field", "n_docs",
                             F.coalesce("total_len", F.lit(0)).cast("long").alias("total_len")))


def corpus_stats(stats: DataFrame) -> DataFrame:
    """(field, n_docs, avgdl) for a view, from per-commit stats rows."""
    return (stats.groupBy("field")
                 .agg(F.sum("n_docs").alias("n_docs"), F.sum("total_len").alias("total_len"))
                 .select("field", "n_docs", "total_len",
                         (F.col("total_len") / F.greatest(F.col("n_docs"), F.lit(1)))
                         .alias("avgdl")))

"""Snippets: the best fragment of a hit's text with matched words in <b>.

Rule (our choice; the reference only calls its library): fragments are cut
greedily at word starts so that (word end - fragment start) <= max chars,
the first fragment starting at offset 0; a fragment weighs the sum over
its matched words of 1 / (1 + df); the heaviest wins, the earliest on a
tie; no match gives the empty string. Offsets count characters.

Runs only on the top-k rows. What is marked in a hit is found by joining the
hit's own tokens with the vocabulary terms the query accepts, so a fuzzy
query may accept any number of terms. The fragment is chosen by one
`aggregate` over the word / non-word pieces with a constant-size state, so
the cost is linear in the text length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import PIECE_PATTERN, tokens
from quarry.operators.predicates import fuzzy_vocabulary, value_ranges
from quarry.operators.ranking import rank_order, stored_fields, stored_name
from quarry.query import Fuzzy, Phrase, Query, Term
from quarry.schema import TEXT, SearchError

# HTML escapes applied to text outside and inside the marks.
HTML_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))
OPEN_MARK, CLOSE_MARK = "<b>", "</b>"

WORD_START = r"^[\p{L}\p{N}]"


def escape_html(c: Column) -> Column:
    for raw, ent in HTML_ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(ent))
    return c


def marked_terms(index, query: Query, field: str) -> DataFrame | None:
    """(term, weight): the vocabulary terms of `field` that the query's leaves
    accept; None if no leaf is on the field."""
    words: set[str] = set()
    parts: list[DataFrame] = []
    for leaf in query.leaves():
        if getattr(leaf, "field", None) != field:
            continue
        if isinstance(leaf, Term):
            words.add(leaf.value)
        elif isinstance(leaf, Phrase):
            words.update(leaf.terms)
        elif isinstance(leaf, Fuzzy):   # the matched variants are what gets marked
            parts.append(index.vocabulary(F.col("field") == field, only=fuzzy_vocabulary(index, leaf)))
    if words:
        parts.append(index.vocabulary((F.col("field") == field) & value_ranges("term", words)
                                      & F.col("term").isin(sorted(words))))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("term", (1.0 / (1.0 + F.col("df"))).alias("weight")).distinct()


def hit_weights(index, hits: DataFrame, text: str, query: Query, field: str) -> DataFrame | None:
    """(doc_id, weights MAP<term, weight>): for each hit the terms of its own
    text that are to be marked; a map is no larger than its text."""
    marked = marked_terms(index, query, field)
    if marked is None:
        return None
    own = hits.select("doc_id", F.explode(F.array_distinct(tokens(text, index.schema.field(field).analyzer))).alias("term"))
    return (own.join(marked, "term").groupBy("doc_id")
               .agg(F.map_from_entries(F.collect_list(F.struct("term", "weight"))).alias("weights")))


def snippet(text: Column, wmap: Column, max_chars: int) -> Column:
    """HTML snippet column for one text column and a term -> weight map (may be null)."""
    wmap = F.coalesce(wmap, F.create_map().cast("map<string,double>"))
    text = F.coalesce(text, F.lit(""))
    def is_token(p):
        return p.rlike(WORD_START)

    # each piece is looked at once: is it a word, how long, what does it weigh
    pieces = F.transform(F.regexp_extract_all(text, F.lit(PIECE_PATTERN), 0), lambda p: F.struct(
        is_token(p).alias("word"), F.char_length(p).alias("len"),
        F.coalesce(F.try_element_at(wmap, F.lower(p)), F.lit(0.0)).alias("weight")))

    def step(acc, p):
        start = acc["off"]
        end = start + p["len"]
        word, w = p["word"], p["weight"]
        brk = word & ((end - acc["fs"]) > F.lit(max_chars))
        better = brk & (acc["fsc"] > acc["bsc"])
        return F.struct(
            end.alias("off"),
            F.when(brk, start).otherwise(acc["fs"]).alias("fs"),
            F.when(word, end).otherwise(acc["fe"]).alias("fe"),
            F.when(brk, w).otherwise(acc["fsc"] + w).alias("fsc"),
            F.when(better, acc["fs"]).otherwise(acc["bs"]).alias("bs"),
            F.when(better, acc["fe"]).otherwise(acc["be"]).alias("be"),
            F.when(better, acc["fsc"]).otherwise(acc["bsc"]).alias("bsc"),
        )

    def finish(acc):
        better = acc["fsc"] > acc["bsc"]
        return F.struct(
            F.when(better, acc["fs"]).otherwise(acc["bs"]).alias("bs"),
            F.when(better, acc["fe"]).otherwise(acc["be"]).alias("be"),
            F.greatest(acc["fsc"], acc["bsc"]).alias("bsc"),
        )

    zero = F.lit(0)
    init = F.struct(zero.alias("off"), zero.alias("fs"), zero.alias("fe"),
                    F.lit(0.0).alias("fsc"), zero.alias("bs"), zero.alias("be"),
                    F.lit(0.0).alias("bsc"))
    best = F.aggregate(pieces, init, step, finish)
    frag = F.substring(text, best["bs"] + 1, best["be"] - best["bs"])
    marked = F.array_join(F.transform(
        F.regexp_extract_all(frag, F.lit(PIECE_PATTERN), 0),
        lambda p: F.when(is_token(p) & F.map_contains_key(wmap, F.lower(p)),
                         F.concat(F.lit(OPEN_MARK), escape_html(p), F.lit(CLOSE_MARK)))
                   .otherwise(escape_html(p))), "")
    return F.when(best["bsc"] > 0, marked).otherwise(F.lit(""))


def attach_snippets(index, top: DataFrame, query: Query, fields, max_chars: int = 150,
                    limit: int | None = None) -> DataFrame:
    """Add `snippets MAP<field, html>` to hits that carry stored text fields.

    Unknown fields are an error; non-text fields are skipped. A text field
    that is not stored is fetched from the corpus for the hits only.
    """
    if not isinstance(max_chars, int) or max_chars < 1:
        raise SearchError("max_snippet_chars must be a positive integer")
    wanted = []
    for f in fields:
        try:
            fd = index.schema.field(f)
        except SearchError:
            raise SearchError(f"Snippet field '{f}' not found in schema") from None
        if fd.type == TEXT:
            wanted.append(f)
    have = {f: stored_name(f) for f in wanted if stored_name(f) in top.columns}
    src = top
    missing = [f for f in wanted if f not in have]
    if missing:
        # text that is not stored is fetched for the hits only
        extra = stored_fields(index, top.select("doc_id"), missing, limit)
        extra = extra.select("doc_id", *[F.col(f"`{stored_name(f)}`").alias(f"__snip_{f}") for f in missing])
        src = top.join(extra, "doc_id", "left")
        have |= {f: f"__snip_{f}" for f in missing}
    pairs = []
    for i, f in enumerate(wanted):
        weights = hit_weights(index, src, f"`{have[f]}`", query, f)
        w = F.lit(None).cast("map<string,double>")
        if weights is not None:
            src = src.join(weights.withColumnRenamed("weights", f"__weights_{i}"), "doc_id", "left")
            w = F.col(f"__weights_{i}")
        pairs += [F.lit(f), snippet(F.col(f"`{have[f]}`"), w, max_chars)]
    snip = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    out = src.withColumn("snippets", snip)
    drop = [c for c in out.columns if c.startswith(("__snip_", "__weights_"))]
    return out.drop(*drop).orderBy(*rank_order())

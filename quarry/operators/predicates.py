"""Leaf operators: each turns one kind of query leaf into rows
(leaf_id, doc_id, score).

Text leaves read the term table filtered on (field, term) so parquet can
skip; prefix and fuzzy leaves first scan the (much smaller) vocabulary;
range and equality leaves read their own part of the value table, which is
clustered on (field, value).
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.distance import edit_distance_to_literal, neighbourhood_probes, prefix_distance_to_literal, within_of_literal
from quarry.operators.analysis import VALUE_COLUMNS
from quarry.sources.corpus import COMMIT_COL
from quarry.operators.scoring import bm25, idf
from quarry.query import Equals, Fuzzy, Nothing, Phrase, Prefix, Range, Term
from quarry.schema import BOOL, I64, NUMERIC_TYPES, TEXT, U64, U64_MAX, SearchError
from quarry.session import scratch_path

LEAF_COLS = ("leaf_id", "doc_id", "score")

# Value ranges that are pushed to a scan for a list of values. Spark pushes an
# IN of more than ten values only as one span from the least to the greatest.
PUSHED_RANGES = 200
# The same where the rows of a large part of the term table are compared with
# them: with more, the code of the scan is too long for the JVM to compile.
SCANNED_RANGES = 24
# Terms of a fuzzy leaf that are brought to the driver to make a filter of.
PUSHED_VALUES = 1000


def in_runs(c: Column, runs: list[tuple]) -> Column:
    """Whether `c` is in one of the ascending, disjoint (least, most) runs, as a
    tree: parquet skips by it as by an OR of them, and a row that is read
    takes a comparison a level, not a pair of them a run."""
    if len(runs) == 1:
        lo, hi = runs[0]
        return (c == F.lit(lo)) if lo == hi else (c >= F.lit(lo)) & (c <= F.lit(hi))
    mid = len(runs) // 2
    at = F.lit(runs[mid][0])
    return ((c < at) & in_runs(c, runs[:mid])) | ((c >= at) & in_runs(c, runs[mid:]))


def value_ranges(column: str, values, most: int | None = None) -> Column:
    """A necessary condition for `column` to be one of the values: an OR of at
    most PUSHED_RANGES (or `most`) ranges (of single values, if there are no
    more), which parquet can skip row groups by."""
    values = sorted(set(values))
    if not values:
        return F.lit(False)
    step = -(-len(values) // (most or PUSHED_RANGES))
    runs = [values[i:i + step] for i in range(0, len(values), step)]
    return in_runs(F.col(column), [(r[0], r[-1]) for r in runs])


def _pairs_filter(pairs) -> Column:
    """OR over fields of (field = f AND term IN (...)); pushed to the scan."""
    by_field = defaultdict(set)
    for f, t in pairs:
        by_field[f].add(t)
    cond = F.lit(False)
    for f, ts in sorted(by_field.items()):
        cond = cond | ((F.col("field") == f) & value_ranges("term", ts) & F.col("term").isin(sorted(ts)))
    return cond


def _empty(index) -> DataFrame:
    return index.spark.createDataFrame([], f"leaf_id int, doc_id {index.id_type}, score double")


def _searchable_text(index, field: str, kind: str = "term") -> bool:
    msgs = {
        "term": None,
        "prefix": f"Field '{field}' is not a text field. Prefix search only works on text fields.",
        "fuzzy": f"Field '{field}' must be a text field. Fuzzy search only works on text fields.",
    }
    f = index.schema.require_text(field, msgs[kind])
    return f.indexed


def term_rows(index, leaves: list[tuple[int, Term]], where: Column | None = None) -> DataFrame:
    """BM25-scored rows for many term leaves with one scan of the term table,
    of the rows `where` selects, if it is given."""
    leaves = [(i, q) for i, q in leaves if _searchable_text(index, q.field)]
    if not leaves:
        return _empty(index)
    spark = index.spark
    lt = spark.createDataFrame([(i, q.field, q.value) for i, q in leaves],
                               "leaf_id int, field string, term string")
    cond = _pairs_filter((q.field, q.value) for _, q in leaves)
    hits = index.terms.where(cond if where is None else cond & where).select("field", "term", "doc_id", "tf", "dl")
    dfs = index.vocabulary(cond).select("field", "term", "df")
    n_docs, avgdl = index.stat_columns()
    # both small sides are bounded by the query's own size (terms x fields)
    j = (hits.join(F.broadcast(lt), ["field", "term"])
             .join(F.broadcast(dfs), ["field", "term"]))
    score = bm25(idf(F.col("df"), n_docs), F.col("tf"), F.col("dl"), avgdl)
    return j.select("leaf_id", "doc_id", score.alias("score"))


def _shifted(positions: str, by: int) -> Column:
    return F.transform(positions, lambda p: p - by)


def _pair_cover(words, common: set[str]) -> list[tuple[int, tuple[str, ...]]]:
    """(offset, word or pair of words) that together are the phrase: pairs of
    common words from the left, the last one of an odd run overlapping."""
    out, covered = [], 0
    for o, w in enumerate(words):
        if o < covered:
            continue
        if w in common and words[o + 1:o + 2] and words[o + 1] in common:
            out.append((o, (w, words[o + 1])))
            covered = o + 2
        elif w in common and o and words[o - 1] in common:
            out.append((o - 1, (words[o - 1], w)))
        else:
            out.append((o, (w,)))
    return out


def _phrase_places(index, field: str, cover, where: Column | None = None) -> DataFrame:
    """(doc_id, dl, pf): how often each document holds all parts of `cover` in place."""
    keys, where = sorted({k for _, k in cover}), F.lit(True) if where is None else where
    ones, twos = [k for k in keys if len(k) == 1], [k for k in keys if len(k) == 2]
    rows = []
    if ones:
        rows.append(index.terms.where(_pairs_filter((field, k[0]) for k in ones) & where)
                         .select(F.array("term").alias("key"), "doc_id", "dl", "positions"))
    if twos:
        wanted = reduce(lambda x, y: x | y, [(F.col("w1") == a) & (F.col("w2") == b) for a, b in twos])
        rows.append(index.pairs.where((F.col("field") == field) & wanted & where)
                         .select(F.array("w1", "w2").alias("key"), "doc_id", "dl", "positions"))
    hits = reduce(DataFrame.unionByName, rows)
    if len(keys) == 1 and len(cover) == 1:
        return hits.select("doc_id", "dl", F.size("positions").alias("pf"))
    per_doc = hits.groupBy("doc_id").agg(F.any_value("dl").alias("dl"), *[
        F.max(F.when(F.col("key") == F.array(*map(F.lit, k)), F.col("positions"))).alias(f"_p{i}") for i, k in enumerate(keys)])
    per_doc = per_doc.where(reduce(lambda x, y: x & y, [F.col(f"_p{i}").isNotNull() for i in range(len(keys))]))
    starts = [_shifted(f"_p{keys.index(k)}", o) for o, k in cover]
    return per_doc.select("doc_id", "dl", F.size(reduce(F.array_intersect, starts)).alias("pf")).where("pf > 0")


def phrase_rows(index, leaf_id: int, q: Phrase) -> DataFrame:
    """Rows of a phrase leaf: one group per document that holds its terms'
    position arrays, shifted by the term's offset and intersected.

    Positions are never exploded and there is one exchange (none for two common
    words). The phrase frequency is the tf of a BM25 score whose idf is the sum
    of the phrase terms' idf.

    Where the index keeps pairs of common words, a phrase is covered by such
    pairs and its other words, so that the long lists of `of` and `the` are not
    read; commits that keep no pairs of these words are searched word by word.
    """
    if not _searchable_text(index, q.field) or not q.terms:
        return _empty(index)
    distinct = sorted(set(q.terms))
    cond = _pairs_filter((q.field, t) for t in distinct)
    cover = [(o, (t,)) for o, t in enumerate(q.terms)]
    common, commits = index.paired(q.field, q.terms) if len(q.terms) > 1 else (set(), [])
    with_pairs = _pair_cover(q.terms, common)
    if not commits or with_pairs == cover:
        freq = _phrase_places(index, q.field, cover)
    else:
        inside = F.col(COMMIT_COL).isin(commits)
        freq = _phrase_places(index, q.field, with_pairs, inside)
        if set(commits) != {c for c in index.commits if index.commit is None or c <= index.commit}:
            freq = freq.unionByName(_phrase_places(index, q.field, cover, ~inside))
    n_docs, avgdl = index.stat_columns(F.lit(q.field))
    # one row a phrase term: a word that the phrase holds twice counts twice
    times = F.create_map(*[x for t in distinct for x in (F.lit(t), F.lit(q.terms.count(t)))])
    idfs = index.vocabulary(cond).select((idf(F.col("df"), n_docs) * F.element_at(times, F.col("term"))).alias("idf"))
    total = F.coalesce(idfs.agg(F.sum("idf").alias("idf")).scalar(), F.lit(0.0))
    score = bm25(F.col("_idf"), F.col("pf"), F.col("dl"), avgdl)
    return freq.withColumn("_idf", total).select(F.lit(leaf_id).alias("leaf_id"), "doc_id", score.alias("score"))


def _java_quote(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def prefix_terms(index, q: Prefix) -> Column:
    """Predicate on the `term` column for a prefix leaf. The tail after the
    lower-cased prefix must be `[a-z0-9]*` over the whole token."""
    p = q.prefix.lower()
    pattern = "^" + _java_quote(p) + "[a-z0-9]*$"
    return ((F.col("field") == q.field) & F.col("term").startswith(p)
            & F.col("term").rlike(pattern))


def prefix_rows(index, leaf_id: int, q: Prefix) -> DataFrame:
    if not _searchable_text(index, q.field, "prefix"):
        return _empty(index)
    # startswith is pushed to parquet; the regex runs only on survivors
    return (index.terms.where(prefix_terms(index, q))
                 .select(F.lit(leaf_id).alias("leaf_id"), "doc_id", F.lit(1.0).alias("score")))


def shared_chars(term: Column, query: str, k: int, window: int | None = None) -> Column:
    """Necessary condition for being within k edits of `query` (codegen'd).

    An edit removes at most one of the query's distinct characters, so a
    match keeps at least distinct(query) - k of them; for a prefix match
    they sit in the first len(query) + k characters.
    """
    chars = sorted(set(query))
    need = len(chars) - k
    if need <= 0:
        return F.lit(True)
    src = F.substring(term, 1, window) if window else term
    return F.size(F.array_intersect(F.split(src, ""), F.array(*[F.lit(c) for c in chars]))) >= need


def fuzzy_vocabulary(index, q: Fuzzy) -> DataFrame:
    """(field, term, distance) for the vocabulary terms the fuzzy leaf accepts.

    Cheap JVM filters (length window, bounded Levenshtein) run before the
    vocabulary is summed over commits; the exact table then runs only on
    the distinct survivors. An index with deletion neighbourhoods is asked for
    the keys the term shares with what is near it, and reads little else.
    """
    k, t, m = q.distance, q.term, len(q.term)
    term = F.col("term")
    base = F.col("field") == q.field
    if q.prefix:
        where = (base & (F.char_length(term) >= F.lit(max(m - k, 0)))
                 & shared_chars(term, t, k, m + k))
        if k == 0:
            where = base & term.startswith(t)
        else:
            where = where & within_of_literal(term, t, k, q.transposition, prefix=True)
        dist = prefix_distance_to_literal(term, t, k, q.transposition)
    else:
        where = base & (F.abs(F.char_length(term) - F.lit(m)) <= k) & shared_chars(term, t, k)
        if k == 0:
            where = base & (term == t)
            dist = F.lit(0)
        elif q.transposition:
            where = where & within_of_literal(term, t, k)
            # plain edits of at most one cannot be bettered by a swap
            plain = F.levenshtein(term, F.lit(t), 2 * k)
            dist = F.when(plain <= 1, plain).otherwise(edit_distance_to_literal(term, t, True))
        else:
            where = where & (F.levenshtein(term, F.lit(t), k) >= 0)
            dist = F.levenshtein(term, F.lit(t))
    if index.near is not None and k and not q.prefix:
        probes = neighbourhood_probes(t, k)
        voc = index.near.where(where & value_ranges("key", probes) & F.col("key").isin(probes)
                               & F.col("n").between(m - k, m + k)).select("field", "term").distinct()
    else:
        voc = index.vocabulary(where).select("field", "term")
    return voc.select("field", "term", dist.alias("distance")).where(F.col("distance") <= k)


def fuzzy_rows(index, leaf_id: int, q: Fuzzy) -> DataFrame:
    """Rows of the documents that hold a term the leaf accepts. The vocabulary
    is matched once: the terms make the filter that is pushed to the scan. If
    they are more than PUSHED_VALUES they are written, ranges over them are
    pushed and the term table is semi-joined with them."""
    if not _searchable_text(index, q.field, "fuzzy"):
        return _empty(index)
    matched = fuzzy_vocabulary(index, q).select("field", "term")
    few = [r["term"] for r in matched.select("term").limit(PUSHED_VALUES + 1).collect()]
    terms = index.terms.where(F.col("field") == q.field)
    if len(few) <= PUSHED_VALUES:
        rows = terms.where(value_ranges("term", few) & F.col("term").isin(few))
    else:
        path = scratch_path(index.spark, "fuzzy")
        matched.write.parquet(path)
        matched = index.spark.read.schema(matched.schema).parquet(path)
        cut = F.ntile(SCANNED_RANGES).over(Window.orderBy("term"))
        spans = matched.select("term", cut.alias("part")).groupBy("part").agg(F.min("term").alias("lo"), F.max("term").alias("hi")).collect()
        within = in_runs(F.col("term"), sorted((r["lo"], r["hi"]) for r in spans))
        rows = terms.where(within).join(matched, ["field", "term"], "left_semi")
    return rows.select(F.lit(leaf_id).alias("leaf_id"), "doc_id", F.lit(1.0).alias("score"))


def _check_numeric(index, q) -> object:
    f = index.schema.field(q.field)
    kind = getattr(q, "kind", None)
    if kind is not None and f.type != kind:
        raise SearchError(
            f"Field '{q.field}' is not a {kind} field. Use search_range_{f.type} instead."
            if f.type in NUMERIC_TYPES else f"Field '{q.field}' is not a {kind} field.")
    return f


def range_condition(index, q: Range) -> Column:
    """The range as a condition on the value table."""
    f = _check_numeric(index, q)
    if f.type not in NUMERIC_TYPES:
        raise SearchError(f"Field '{q.field}' is not a numeric field")
    for b in (q.lower, q.upper):
        if b is None:
            continue
        if isinstance(b, bool) or not isinstance(b, (int, float)):
            raise SearchError(f"Range bound {b!r} is not a number")
        if f.type in (U64, I64) and not isinstance(b, int):
            raise SearchError(f"Range bounds on '{q.field}' must be integers")
        if f.type == U64 and b < 0:
            raise SearchError(f"Range bounds on u64 field '{q.field}' must be non-negative")
    c = F.col(VALUE_COLUMNS[f.type])
    lit = (lambda v: F.lit(str(v)).cast("decimal(20,0)")) if f.type == U64 else F.lit
    if f.type == U64:
        # a bound past the type: nothing above it, everything below it
        if q.lower is not None and q.lower > U64_MAX:
            return F.lit(False)
        if q.upper is not None and q.upper > U64_MAX:
            q = replace(q, upper=None)
    lo_inc = q.inclusive in ("both", "lower")
    hi_inc = q.inclusive in ("both", "upper")
    cond = (F.col("field") == q.field) & c.isNotNull()
    if q.lower is not None:
        cond = cond & ((c >= lit(q.lower)) if lo_inc else (c > lit(q.lower)))
    if q.upper is not None:
        cond = cond & ((c <= lit(q.upper)) if hi_inc else (c < lit(q.upper)))
    return cond


def _value_rows(index, leaf_id: int, field: str, cond: Column) -> DataFrame:
    if not index.schema.field(field).indexed:
        return _empty(index)
    return index.values.where(cond).select(F.lit(leaf_id).alias("leaf_id"), "doc_id", F.lit(1.0).alias("score"))


def range_rows(index, leaf_id: int, q: Range) -> DataFrame:
    return _value_rows(index, leaf_id, q.field, range_condition(index, q))


def equals_condition(index, q: Equals) -> Column:
    """The equality as a condition on the value table."""
    f = index.schema.field(q.field)
    if f.type == TEXT:
        raise SearchError(f"Field '{q.field}' is a text field; use a term query")
    if f.type == BOOL and not isinstance(q.value, bool):
        raise SearchError(f"Field '{q.field}' is a bool field")
    if f.type != BOOL and (isinstance(q.value, bool) or not isinstance(q.value, (int, float))):
        raise SearchError(f"Field '{q.field}' is a {f.type} field")
    if f.type == U64:
        if not isinstance(q.value, int) or not 0 <= q.value <= U64_MAX:
            return F.lit(False)
        value = F.lit(str(q.value)).cast("decimal(20,0)")
    else:
        value = F.lit(int(q.value) if f.type == BOOL else q.value)
    return (F.col("field") == q.field) & (F.col(VALUE_COLUMNS[f.type]) == value)


def equals_rows(index, leaf_id: int, q: Equals) -> DataFrame:
    return _value_rows(index, leaf_id, q.field, equals_condition(index, q))


def leaf_rows(index, leaves: list[tuple[int, object]]) -> DataFrame:
    """Union of the rows of all leaves; term leaves share a scan."""
    parts = []
    terms = [(i, q) for i, q in leaves if isinstance(q, Term)]
    if terms:
        parts.append(term_rows(index, terms))
    for i, q in leaves:
        if isinstance(q, Phrase):
            parts.append(phrase_rows(index, i, q))
        elif isinstance(q, Prefix):
            parts.append(prefix_rows(index, i, q))
        elif isinstance(q, Fuzzy):
            parts.append(fuzzy_rows(index, i, q))
        elif isinstance(q, Range):
            parts.append(range_rows(index, i, q))
        elif isinstance(q, Equals):
            parts.append(equals_rows(index, i, q))
        elif isinstance(q, Nothing):
            parts.append(_empty(index))
        elif not isinstance(q, Term):
            raise SearchError(f"Unknown query leaf {q!r}")
    return reduce(DataFrame.unionByName, parts)

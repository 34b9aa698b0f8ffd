"""The value table and the deletion neighbourhoods: right rows from few rows read."""

import random

import pytest
from pyspark.sql import functions as F

from quarry import Equals, Fuzzy, Index, Range, Schema, Searcher, Term, all_of
from quarry.functions.distance import neighbourhood_keys, neighbourhood_probes
from quarry.operators.predicates import fuzzy_vocabulary
from tests.test_index import _rows_read

NUMBERS = (Schema().add_text_field("text", stored=True).add_u64_field("u", stored=True).add_i64_field("i", stored=True)
           .add_f64_field("f", stored=True).add_bool_field("b", stored=True).add_i64_field("hidden", stored=True, indexed=False))


def _ids(df):
    return sorted(r["doc_id"] for r in df.collect())


@pytest.fixture(scope="module")
def numbers(spark, tmp_path_factory):
    df = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("word w"), F.col("id") % 7).alias("text"),
        (F.col("id") * 7919 % 60_000).alias("u"), (F.col("id") * 104_729 % 60_000 - 30_000).alias("i"),
        F.when(F.col("id") % 10 != 0, F.col("id") / 4).alias("f"), (F.col("id") % 1000 == 0).alias("b"), F.col("id").alias("hidden"))
    return df, Index.build(df, NUMBERS, path=str(tmp_path_factory.mktemp("values") / "ix"))


CASES = [
    (Range("u", 100, 199), "u between 100 and 199"), (Range("u", None, 5, "lower"), "u < 5"), (Range("u", 59_990, None, "upper"), "u > 59990"),
    (Range("i", -30, -20, "neither"), "i > -30 and i < -20"), (Range("i", -5, 5, "both", "i64"), "i between -5 and 5"),
    (Range("f", 10.25, 20.0), "f between 10.25 and 20"), (Equals("f", 33.25), "f = 33.25"), (Equals("u", 777), "u = 777"),
    (Equals("b", True), "b"), (Equals("i", -30_000), "i = -30000"), (Range("hidden", 1, 5), "false"), (Range("u", 70_000, None), "false")]


@pytest.mark.parametrize("query, where", CASES, ids=[w for _, w in CASES])
def test_ranges_read_about_their_hits(numbers, query, where):
    df, idx = numbers
    hits = Searcher(idx).hits(query)
    want = _ids(df.where(where))
    assert _ids(hits) == want
    assert {r["score"] for r in hits.collect()} <= {1.0}
    if query.field != "hidden":
        # whole pages of a thousand values: the corpus has 60,000 rows
        assert _rows_read(hits) <= len(want) + 2_000


def test_text_with_a_range_and_snapshots(spark, numbers, tmp_path):
    df, idx = numbers
    got = Searcher(idx).hits(all_of(Term("text", "w3"), Range("u", 0, 500)))
    assert _ids(got) == _ids(df.where("id % 7 = 3 and u <= 500".replace("id", "doc_id")))
    small = df.limit(10)
    two = Index.build(small, NUMBERS, path=str(tmp_path / "two")).append(df.where("doc_id between 100 and 119"), 1).append(df.limit(0), 2)
    everything = Range("u", 0, None)
    assert len(_ids(Searcher(two).hits(everything))) == 30
    assert len(_ids(Searcher(two.as_of(0)).hits(everything))) == 10
    assert Index.from_corpus(small, NUMBERS).values.count() == two.as_of(0).values.count()


def test_no_numeric_field(spark, tmp_path):
    s = Schema().add_text_field("text")
    idx = Index.build(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), s, path=str(tmp_path / "ix"))
    assert idx.values.count() == 0 and idx.near is None and _ids(Searcher(idx).hits(Term("text", "a"))) == [1]


def _distance(a, b, swaps):
    """Optimal string alignment, or plain edits."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if swaps and i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def _edited(rng, w, n):
    for _ in range(n):
        i = rng.randrange(len(w) + 1)
        kind = rng.randrange(4)
        c = rng.choice("abcdé")
        w = (w[:i] + c + w[i:] if kind == 0 else w[:i] + w[i + 1:] if kind == 1 else w[:i] + c + w[i + 1:] if kind == 2
             else w[:i] + w[i + 1:i + 2] + w[i:i + 1] + w[i + 2:])
    return w


def test_neighbours_of_all_lengths(spark, tmp_path):
    """Short terms by deletions, long ones by segments: exactly the near terms."""
    rng = random.Random(5)
    bases = ["".join(rng.choice("abcdé") for _ in range(n)) for n in (1, 2, 3, 4, 8, 14, 15, 16, 17, 18, 19, 25, 60, 400)]
    words = sorted({w for b in bases for _ in range(60) for w in [_edited(rng, b, rng.randrange(4))] if w} | set(bases))
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, text string")
    idx = Index.build(df, Schema().add_text_field("text"), path=str(tmp_path / "ix"), near=True)
    for b in bases:
        for k in (1, 2):
            for swaps in (True, False):
                q = Fuzzy("text", b, k, swaps)
                got = {r["term"] for r in fuzzy_vocabulary(idx, q).collect()}
                assert got == {w for w in words if abs(len(w) - len(b)) <= k and _distance(w, b, swaps) <= k}, (b, k, swaps)
    assert len(neighbourhood_probes("x" * 400 + "y", 2)) <= 125
    long = spark.createDataFrame([("ab" * 50_000,)], "term string").select(F.explode(neighbourhood_keys("term"))).collect()
    assert len(long) == 5


def test_a_fuzzy_leaf_reads_little(spark, tmp_path):
    """Out of 30,000 terms (a million keys) a search reads a few pages of keys."""
    words = spark.range(30_000).select(F.col("id").alias("doc_id"), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 8).alias("text"))
    idx = Index.build(words, Schema().add_text_field("text"), path=str(tmp_path / "ix"), near=True)
    target = words.where("doc_id = 77").first()["text"]
    matched = fuzzy_vocabulary(idx, Fuzzy("text", target[:3] + target[4:], 1))
    assert target in {r["term"] for r in matched.collect()}
    keys = idx.near.count()
    plan = idx.near.where((F.col("field") == "text") & F.col("key").isin(neighbourhood_probes(target, 1)))
    assert keys > 600_000 and _rows_read(matched) < keys / 100 and plan.count() >= 8
    # appended commits are searched too, and a view pinned before them is not
    more = idx.append(spark.createDataFrame([(90_000, target[:7] + "x")], "doc_id long, text string"), 1)
    hits = Searcher(more).hits(Fuzzy("text", target, 1))
    assert {77, 90_000} <= set(_ids(hits)) and 90_000 not in _ids(Searcher(more.as_of(0)).hits(Fuzzy("text", target, 1)))


def test_many_matched_terms_are_joined(spark, tmp_path, monkeypatch):
    from quarry.operators import predicates
    letters = "abcdefghij"
    words = [f"{x}{y}{z}" for x in letters for y in letters for z in letters]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, text string")
    idx = Index.build(df, Schema().add_text_field("text"), path=str(tmp_path / "ix"), near=True)
    few = _ids(Searcher(idx).hits(Fuzzy("text", "abc", 2)))
    monkeypatch.setattr(predicates, "PUSHED_VALUES", 50)
    assert _ids(Searcher(idx).hits(Fuzzy("text", "abc", 2))) == few and len(few) > 200


def test_halves_find_what_two_edits_leave(spark):
    """Terms of 9 to 16 characters by their halves: a swap across the middle, an edit in each, few keys a term."""
    from quarry.functions.distance import HALF_MARK
    rng = random.Random(8)
    pairs = set()
    for n in range(7, 19):
        for _ in range(120):
            b = "".join(rng.choice("abé") for _ in range(n))
            h = n // 2
            pairs |= {(_edited(rng, b, 1), b), (_edited(rng, b, 2), b), (b[:h - 1] + b[h] + b[h - 1] + b[h + 1:], b)}
            swap = b[:h - 1] + b[h] + b[h - 1] + b[h + 1:]
            pairs.add((_edited(rng, swap, 1), b))
    df = spark.createDataFrame(sorted(pairs), "word string, term string").select("word", "term", neighbourhood_keys("term").alias("keys"))
    for r in df.collect():
        for k in (1, 2):
            if _distance(r["word"], r["term"], True) <= k:
                assert set(neighbourhood_probes(r["word"], k)) & set(r["keys"]), (r["word"], r["term"], k)
        if 9 <= len(r["term"]) <= 16:
            assert len(r["keys"]) <= len(r["term"]) + 2 and all(x.startswith(HALF_MARK) for x in r["keys"])


def test_ranges_are_a_tree(spark):
    """Two hundred ranges: the right rows, by a few comparisons a row."""
    from quarry.operators.predicates import PUSHED_RANGES, in_runs, value_ranges
    runs = [(f"{i:04d}", f"{i + 2:04d}") for i in range(0, 2000, 10)]
    df = spark.range(2100).select(F.format_string("%04d", "id").alias("w"))
    got = {r["w"] for r in df.where(in_runs(F.col("w"), runs)).collect()}
    assert got == {f"{i:04d}" for i in range(2000) if i % 10 <= 2}
    names = [f"{i:04d}" for i in range(0, 2000, 5)]
    assert set(names) <= {r["w"] for r in df.where(value_ranges("w", names)).collect()}
    assert df.where(value_ranges("w", names[:3])).count() == 3 and df.where(value_ranges("w", [])).count() == 0

    def depth(tree):                   # of nested conditions, by their brackets
        most = now = 0
        for ch in tree:
            now += (ch == "(") - (ch == ")")
            most = max(most, now)
        return most

    assert depth(df.where(value_ranges("w", names))._jdf.queryExecution().analyzed().toString()) < 40 < PUSHED_RANGES

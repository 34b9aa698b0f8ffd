"""Facets, hits in the order of a field, and which earlier ids a commit reads."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry import Index, Prefix, Range, Schema, Searcher, SearchError, Term, any_words
from quarry.operators import batch
from tests.test_index import _rows_read

SCHEMA = (Schema().add_text_field("text", stored=True).add_text_field("lang", stored=True).add_u64_field("views", stored=True)
          .add_i64_field("temp", stored=True).add_f64_field("price", stored=True).add_bool_field("ok", stored=True).add_u64_field("secret"))


def _rows(n):
    return [(i, "common " + ("even" if i % 2 == 0 else "odd"), ["en", "de", None][i % 3], None if i % 10 == 9 else i * 37 % 101,
             i % 13 - 6, None if i % 4 == 0 else (i % 5) / 2, [True, False, None][i % 3], i) for i in range(n)]


@pytest.fixture(scope="module")
def searcher(spark, tmp_path_factory):
    df = spark.createDataFrame(_rows(300), "doc_id long, text string, lang string, views long, temp long, price double, ok boolean, secret long")
    path = str(tmp_path_factory.mktemp("facets") / "ix")
    return Searcher(Index.build(df.where("doc_id < 200"), SCHEMA, path=path).append(df.where("doc_id >= 200"), 1))


def _counts(df):
    return {(r["facet"], r["value"]): r["count"] for r in df.collect()}


def test_facets_count_hits(searcher):
    rows = [r for r in _rows(300) if r[0] % 2 == 0]
    got = _counts(searcher.facets(Term("text", "even"), ["lang", "ok", ("views", [10, 50]), ("temp", [-3, 0]), ("price", [0.5, 1.5])]))

    def label(v, edges):
        return f"(*, {edges[0]})" if v < edges[0] else f"[{edges[0]}, {edges[1]})" if v < edges[1] else f"[{edges[1]}, *)"

    want = Counter()
    for _, _, lang, views, temp, price, ok, _ in rows:
        want.update([("lang", lang)] * (lang is not None) + [("ok", str(ok).lower())] * (ok is not None) + [("temp", label(temp, [-3, 0]))])
        want.update([(n, label(v, e)) for n, v, e in (("views", views, [10, 50]), ("price", price, [0.5, 1.5])) if v is not None])
    assert got == dict(want)
    top = _counts(searcher.facets(Term("text", "common"), ["lang"], limit=7))
    assert sum(top.values()) <= 7 and top == dict(Counter(("lang", _rows(300)[r["doc_id"]][2]) for r in searcher.search(
        Term("text", "common"), 7, stored=False).collect() if _rows(300)[r["doc_id"]][2]))
    assert _counts(searcher.facets(Term("text", "absent"), ["lang"])) == {}
    # one pass: a single expand over the hits
    plan = searcher.facets(Term("text", "even"), ["lang", "ok"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1


def test_facet_errors(searcher):
    for by, why in ([["secret"], "not stored"], [["nosuch"], "not found"], [[("lang", [1])], "not a numeric"], [[("views", [3, 1])], "ascend"],
                    [[("views", [])], "ascend"], [[], "At least one facet"]):
        with pytest.raises(SearchError, match=why):
            searcher.facets(Term("text", "even"), by)


@pytest.mark.parametrize("field, descending", [("views", False), ("views", True), ("temp", True), ("price", False), ("ok", True)])
def test_pages_joined_are_the_whole_order(searcher, field, descending):
    at = ["id", "text", "lang", "views", "temp", "price", "ok"].index(field)
    rows = [(r[at], r[0]) for r in _rows(300) if r[0] % 2 and r[at] is not None]
    want = sorted(rows, key=lambda r: (-r[0] if descending else r[0], r[1]))
    got, after = [], None
    while True:
        page = searcher.search_sorted(Term("text", "odd"), field, descending, 60, after, stored=False)
        if (after := searcher.cursor(page)) is None:
            break
        got += [(r["value"], r["doc_id"]) for r in page.collect()]
    assert got == want


def test_sorted_hits_carry_scores_and_fields(searcher):
    first = searcher.search_sorted(Prefix("text", "ev"), "views", limit=3).collect()
    assert [r["value"] for r in first] == sorted(r["value"] for r in first) and first[0]["text"] == "common even" and first[0]["score"] == 1.0
    few = searcher.search_sorted(Range("views", 100, None), "temp", limit=50).collect()
    assert {r["doc_id"] for r in few} == {r[0] for r in _rows(300) if r[3] is not None and r[3] >= 100}
    for field, why in (("text", "no order"), ("nosuch", "not found")):
        with pytest.raises(SearchError, match=why):
            searcher.search_sorted(Term("text", "odd"), field)
    with pytest.raises(SearchError, match="positive"):
        searcher.search_sorted(Term("text", "odd"), "views", limit=0)


def test_a_cursor_reads_what_lies_beyond_it(spark, tmp_path):
    s = Schema().add_u64_field("n")
    idx = Index.build(spark.range(50_000).select(F.col("id").alias("doc_id"), (F.col("id") * 7 % 50_000).alias("n")), s, path=str(tmp_path / "ix"))
    from quarry.operators.facets import sorted_page
    hits = idx.values.select("doc_id", F.lit(1.0).alias("score"))
    page = sorted_page(idx, hits, "n", False, 10, (49_900, 0))
    assert [int(r["value"]) for r in page.collect()] == list(range(49_900, 49_910))
    beyond = idx.values.where((F.col("field") == "n") & (F.col("dec") >= F.lit("49900").cast("decimal(20,0)")))
    assert _rows_read(beyond.select("doc_id")) < 2_000


def test_a_commit_reads_the_ids_near_its_own(spark, tmp_path):
    s = Schema().add_text_field("text")
    frame = lambda a, b: spark.range(a, b).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    idx = Index.build(frame(0, 30_000), s, path=str(tmp_path / "ix")).append(frame(30_000, 30_010), 1)
    higher, among = frame(30_010, 30_500), frame(29_990, 30_400)
    higher.write.parquet(str(tmp_path / "higher")), among.write.parquet(str(tmp_path / "among"))
    ids = {k: Index._ids_near(idx.corpus, spark.read.parquet(str(tmp_path / k)), "doc_id") for k in ("higher", "among")}
    assert ids["higher"].count() == 0 and _rows_read(ids["higher"]) < 100
    assert ids["among"].count() == 20
    with pytest.raises(SearchError, match="indexed already"):
        idx.append(among, 2)
    with pytest.raises(SearchError, match="occurs 2 times"):
        idx.append(higher.unionByName(higher.limit(1)), 2)
    assert idx.append(higher, 2).corpus.count() == 30_500        # what was refused left nothing behind


def test_queries_of_the_same_words_are_one(spark, searcher):
    table = spark.createDataFrame([(1, "even common"), (2, "common even"), (3, "Even, COMMON!"), (4, "common"), (5, "common common")],
                                  "query_id long, text string")
    got = {}
    for r in batch.batch_search(searcher.index, table, "text", 4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], round(r["score"], 9)))
    assert sorted(got[1]) == sorted(got[2]) == sorted(got[3]) and set(got) == {1, 2, 3, 4, 5}
    for q, text in ((1, "even common"), (5, "common common")):
        want = [(r["doc_id"], round(r["score"], 9)) for r in searcher.search(any_words(["text"], text), 4, stored=False).collect()]
        assert [x[1:] for x in sorted(got[q])] == want

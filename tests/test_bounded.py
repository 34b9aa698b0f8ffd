"""Bounded top-k: the same hits from fewer rows."""

import random

import pytest
from pyspark.sql import functions as F

from quarry import Index, Schema, Searcher, Term, all_of, any_words, match
from quarry.operators import analysis, bounded
from quarry.query import Bool, Fuzzy
from tests.test_index import _rows_read

SCHEMA = Schema().add_text_field("text", stored=True).add_text_field("title")


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(3)
    words = ["the", "of", "and"] + [f"w{i}" for i in range(400)]
    weights = [60, 40, 20] + [30 / (i + 3) for i in range(400)]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 40)) + (["data"] * (1 + i % 3) if i % 997 == 5 else [])
                                    + (["language"] if i % 211 == 7 else [])), rng.choice(["the one", "of it", ""])) for i in range(12_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, title string")
    path = str(tmp_path_factory.mktemp("bounded") / "ix")
    with pytest.MonkeyPatch.context() as m:
        m.setattr("quarry.plans.index.TERM_PAGE_ROWS", 25)      # as many pages as a large table has
        return Index.build(df.where("doc_id < 9000"), SCHEMA, path=path).append(df.where("doc_id >= 9000"), 1).append(df.limit(0), 2)


QUERIES = [any_words(["text"], "the language of data"), Term("text", "the"), any_words(["text"], "w3 w9 w300"), any_words(["text", "title"], "the data"),
           any_words(["text"], "the the data"), Term("text", "nosuch"), any_words(["text"], "nosuch language"), any_words(["text"], "the of and w0 w1")]


@pytest.mark.parametrize("query", QUERIES, ids=str)
def test_same_hits(index, query, monkeypatch):
    s = Searcher(index)
    for view in (s, Searcher(index.as_of(0))):
        for k in (10, 150) if query is QUERIES[0] else (10,):
            monkeypatch.setattr(bounded, "BOUNDED_FROM", 10 ** 12)
            want = [(r["doc_id"], round(r["score"], 9)) for r in view.search(query, k, stored=False).collect()]
            monkeypatch.setattr(bounded, "BOUNDED_FROM", 0)
            assert bounded.bounded_hits(view.index, query, k) is not None
            assert [(r["doc_id"], round(r["score"], 9)) for r in view.search(query, k, stored=False).collect()] == want
        if view is s and query is not QUERIES[0]:
            break


@pytest.mark.parametrize("ranges", [1, 3])
def test_ranges_that_span_the_first_blocks(index, monkeypatch, ranges):
    """With fewer ranges than blocks, no document comes twice, be there few first blocks or many."""
    monkeypatch.setattr("quarry.operators.predicates.PUSHED_RANGES", ranges)
    s = Searcher(index)
    for query, k in ((QUERIES[0], 10), (QUERIES[1], 10), (QUERIES[0], 150)):
        monkeypatch.setattr(bounded, "BOUNDED_FROM", 10 ** 12)
        want = [(r["doc_id"], round(r["score"], 9)) for r in s.search(query, k, stored=False).collect()]
        monkeypatch.setattr(bounded, "BOUNDED_FROM", 0)
        assert [(r["doc_id"], round(r["score"], 9)) for r in s.search(query, k, stored=False).collect()] == want
    snippets = [r["snippets"]["text"] for r in s.search_with_snippets(QUERIES[0], ["text"], 150, 10).collect()]
    assert len(snippets) == 10 and all("<b>" in x for x in snippets)


def test_fewer_rows_are_read(index, monkeypatch):
    monkeypatch.setattr(bounded, "BOUNDED_FROM", 0)
    query = QUERIES[0]
    hits = Searcher(index).hits(query).count()
    seen = []
    original = bounded.term_rows
    monkeypatch.setattr(bounded, "term_rows", lambda ix, leaves, where: seen.append(where) or original(ix, leaves, where))
    bounded.bounded_hits(index, query, 10)
    terms = index.terms.where((F.col("field") == "text") & F.col("term").isin(["the", "language", "of", "data"]))
    read = [_rows_read(terms.where(w).select("doc_id")) for w in seen]
    assert len(read) == 2 and sum(read) < hits, (read, hits)


def test_what_it_is_not_for(index, make_index, monkeypatch):
    assert bounded.bounded_hits(index, QUERIES[0], 10) is None            # too few rows to be worth two passes
    monkeypatch.setattr(bounded, "BOUNDED_FROM", 0)
    for q in (all_of(Term("text", "the"), Term("text", "of")), Fuzzy("text", "the"), match("text", "of the"),
              Bool(should=[Term("text", "the")], must_not=[Term("text", "of")])):
        assert bounded.bounded_hits(index, q, 10) is None
    assert bounded.bounded_hits(make_index(SCHEMA, [{"text": "the"}]), Term("text", "the"), 10) is None


def test_bounds_hold_for_every_block(index):
    """No document adds more than its block's top, in either commit."""
    n, mean = index.stat_values()["text"]
    rows = index.terms.where("field = 'text' and term in ('the', 'of', 'and')")
    share = F.col("tf") / (F.col("tf") + 1.2 * (0.25 + 0.75 * F.col("dl") / mean))
    joined = rows.join(index.tops, ["field", "term", "commit_id", "_block"])
    assert joined.count() == rows.count()
    assert joined.where(share > F.col("top") * index.mean_growth("text") + 1e-12).count() == 0
    assert index.tops.select("term").distinct().count() < 60 and "_block" not in index.corpus.columns


def test_tops_follow_the_documents(spark, tmp_path, monkeypatch):
    """A word in few of a block's documents keeps no tops, which would be as many as its rows; the hits are the same."""
    monkeypatch.setattr("quarry.operators.analysis.FREQUENT", 2)
    df = spark.createDataFrame([(i, "all " + "half " * (i % 2) + "few " * (i % 50 == 3) * (1 + i % 3)) for i in range(2_000)], "doc_id long, text string")
    index = Index.build(df, Schema().add_text_field("text"), path=str(tmp_path / "ix"))
    kept = {r["term"]: r["n"] for r in index.tops.groupBy("term").agg(F.count("*").alias("n")).collect()}
    assert set(kept) == {"all", "half"} and sum(kept.values()) <= 2 * 2_000 / 4
    for words in ("few", "all few", "half few all"):
        query = any_words(["text"], words)
        monkeypatch.setattr(bounded, "BOUNDED_FROM", 10 ** 12)
        want = [(r["doc_id"], round(r["score"], 9)) for r in Searcher(index).search(query, 10, stored=False).collect()]
        monkeypatch.setattr(bounded, "BOUNDED_FROM", 0)
        assert [(r["doc_id"], round(r["score"], 9)) for r in Searcher(index).search(query, 10, stored=False).collect()] == want


def test_tops_of_few_words_are_a_filter_of_the_scan(index, monkeypatch):
    """A row of the term table is not looked up in a join for them; more words than are filtered by give the same tops."""
    terms, vocab = index.as_of(0).terms, index._pin(index._vocab).where("commit_id = 0")
    mean = {f: a for f, (_, a) in index.as_of(0).stat_values().items()}

    def tops():
        df = analysis.block_tops(terms, vocab, mean, 9_000)
        return "Join" in df._jdf.queryExecution().optimizedPlan().toString(), sorted(map(tuple, df.collect()))

    joined, filtered = tops()
    assert not joined and filtered == sorted(tuple(r) for r in index.as_of(0).tops.select("field", "term", "_block", "top").collect())
    share = F.col("tf") / (F.col("tf") + 1.2 * (0.25 + 0.75 * F.col("dl") / mean["text"]))
    best = {(r["term"], r["_block"]): r["top"] for r in terms.where("field = 'text'").groupBy("term", "_block").agg(F.max(share).alias("top")).collect()}
    kept = {r["term"] for r in vocab.where("field = 'text' and df >= 512 and df * 32 >= 9000").collect()}
    assert {(t, b): pytest.approx(best[t, b]) for t, b in best if t in kept} == {(t, b): x for f, t, b, x in filtered if f == "text"}
    for limit in ("FILTER_WORDS", "BROADCAST_WORDS"):
        monkeypatch.setattr(analysis, limit, 0)
        assert tops() == (True, filtered)

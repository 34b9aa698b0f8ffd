"""Many queries of any form in one job: equal to one search after another."""

import random

import pytest
from pyspark.sql import functions as F

from quarry import Equals, Fuzzy, Index, Phrase, Prefix, Range, Schema, Searcher, Term, all_of, any_of, boolean
from quarry.operators import batch_queries
from quarry.query import Bool, Nothing
from quarry.querystring import parse
from quarry.schema import SearchError

SCHEMA = (Schema().add_text_field("title", stored=True).add_text_field("body").add_u64_field("views", stored=True).add_bool_field("ok")
          .add_i64_field("temp"))
WORDS = "the of a and spark search index query elixir rust web data phoenix phonix language in".split()


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randrange(1, 5))),
             " ".join(rng.choices(WORDS, weights=[40, 20, 10] + [2] * 13, k=rng.randrange(0, 25))), rng.randrange(1000), i % 3 == 0,
             rng.randrange(-20, 20)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, title string, body string, views long, ok boolean, temp long")
    path = str(tmp_path_factory.mktemp("batch") / "ix")
    return Index.build(df.where("doc_id % 2 = 0"), SCHEMA, path=path).append(df.where("doc_id % 2 = 1"), 1)


STRINGS = ["the", "the", "the of", "title:spark", '"of the"', 'body:"the the of"', "+spark -rust", "spark NOT the", "a AND (web OR data)",
           "views:[100 TO 300]", "the AND views:[* TO 50]", "ok:true AND rust", "temp:-5 OR temp:[3 TO 4]", "", '"--"', "nosuchword", "nosuch of",
           "+the +of +and -a", "(spark AND search) OR (rust AND web AND NOT the)", "body:(the OR and) AND title:data", "the the the", "the index",
           '+"of the" the -ok:true', "of of the AND views:{10 TO 900}", "a OR (of AND (the OR (and AND spark)))"]


def _loop(index, queries, k):
    s, out = Searcher(index), []
    for name, q in queries:
        rows = s.search(q, k, stored=False).collect() if k else s.hits(q).collect()
        rows = sorted(((r["doc_id"], round(r["score"], 9)) for r in rows), key=lambda r: (-r[1], r[0]))
        out += [(name, n + 1 if k else None, *r) for n, r in enumerate(rows)]
    return sorted(out, key=str)


def _got(df):
    return sorted(((r["query_id"], r["rank"] if "rank" in df.columns else None, r["doc_id"], round(r["score"], 9)) for r in df.collect()), key=str)


@pytest.mark.parametrize("k", [3, None])
def test_strings_as_one_by_one(spark, index, k):
    table = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(STRINGS)] + [("null", None)], "query_id string, text string")
    want = _loop(index, [(f"q{i}", parse(SCHEMA, ["title", "body"], t)) for i, t in enumerate(STRINGS)], k)
    assert _got(Searcher(index).batch_query_strings(table, ["title", "body"], k)) == want


def test_values_as_one_by_one(index):
    rng = random.Random(4)
    leaves = [Term("body", w) for w in WORDS] + [Phrase("body", ["the", "of"]), Phrase("title", ["spark"]), Prefix("body", "pho"),
              Fuzzy("body", "phonex", 2), Fuzzy("title", "serch", 1), Fuzzy("body", "lang", 1, prefix=True), Range("views", 10, 400),
              Equals("ok", True), Range("temp", None, 0), Nothing(), Term("title", "Spark")]

    def query(depth):
        if depth == 0 or rng.random() < .3:
            return rng.choice(leaves)
        parts = [[query(depth - 1) for _ in range(rng.randrange(0, n))] for n in (3, 4, 2)]
        if not parts[0] and not parts[1]:
            parts[1] = [query(depth - 1)]
        return Bool(*parts)

    queries = [(i, query(2)) for i in range(9)] + [(9, leaves[18]), (10, leaves[19])]
    want = _loop(index, queries, 5)
    assert _got(Searcher(index).batch_queries(dict(queries), 5)) == want
    every = _got(Searcher(index).batch_queries(dict(queries), None))
    assert {(r[0], *r[2:]) for r in want} <= {(r[0], *r[2:]) for r in every}


def test_equal_queries_are_one_program_and_blocks_join(spark, index, monkeypatch):
    table = spark.range(1000).select(F.col("id").alias("query_id"), F.lit("the").alias("text"))
    block = batch_queries._Block([(i, Term("body", "the")) for i in range(1000)])
    assert len(block.programs) == 1 and len(block.leaf_ids) == 1 and len(block.asked) == 1000
    got = Searcher(index).batch_query_strings(table, ["body"], 2).collect()
    assert len(got) == 2000 and len({(r["rank"], r["doc_id"]) for r in got}) == 2
    monkeypatch.setattr(batch_queries, "BLOCK_QUERIES", 3)
    some = spark.createDataFrame(list(enumerate(STRINGS[:5])), "query_id long, text string")
    want = _loop(index, [(i, parse(SCHEMA, ["body"], t)) for i, t in enumerate(STRINGS[:5])], 4)
    assert _got(Searcher(index).batch_query_strings(some, ["body"], 4)) == want


def test_a_required_rare_word_leaves_a_frequent_one_out(index):
    """The cover of a conjunction is its rarest clause; of a disjunction the weak words are not."""
    q = all_of(Term("body", "the"), Term("body", "elixir"))
    block = batch_queries._Block([(0, q), (1, boolean(must=[any_of(Term("body", "the"), Term("body", "web"))], must_not=[Term("body", "a")]))])
    counts = {i: {"the": 300, "elixir": 4, "web": 5, "a": 100}[leaf.value] for leaf, i in block.leaf_ids.items()}
    names = {i: leaf.value for leaf, i in block.leaf_ids.items()}
    assert {names[i] for i in block.cover(q, counts)} == {"elixir"}
    assert {names[i] for i in block.cover(block.programs[1].query, counts)} == {"the", "web"}
    wide = any_of(*[Term("body", w) for w in ("elixir", "web", "the")])
    block = batch_queries._Block([(0, wide)])
    matched = batch_queries._matched(index, block)
    stats = matched.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("top")).collect()
    counts, tops = {r["leaf"]: r["n"] for r in stats}, {r["leaf"]: r["top"] for r in stats}
    weak = batch_queries._thresholds(index, block, matched, counts, tops, 2)
    assert block.leaf_ids[Term("body", "the")] in weak[0] and len(weak[0]) < 3


def test_errors_name_the_query(spark, index):
    table = spark.createDataFrame([(1, "a"), (2, "a AND"), (3, "b")], "query_id long, text string")
    with pytest.raises(SearchError, match="Query 2"):
        Searcher(index).batch_query_strings(table, ["body"])
    with pytest.raises(SearchError, match="default field"):
        Searcher(index).batch_query_strings(table, [])
    assert Searcher(index).batch_query_strings(table.limit(0), ["body"]).collect() == []
    assert Searcher(index).batch_queries({}).collect() == []

"""Scans of a large part of the term table run as compiled code."""

import re

from pyspark.sql import DataFrame

from quarry import Fuzzy, Index, Schema, Searcher
from quarry.operators import batch_queries, predicates

# Methods of more bytes of code are interpreted by the JVM, row by row.
COMPILED_BYTES = 8_000


def _longest(df) -> int:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode))))


def _index(spark, path):
    words = [f"{x}{y}{z}" for x in "abcdefghij" for y in "abcdefghij" for z in "abcdefghij"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, text string")
    return words, Index.build(df, Schema().add_text_field("text"), path=str(path))


def test_scans_of_many_terms_are_compiled(spark, tmp_path, monkeypatch):
    words, idx = _index(spark, tmp_path / "ix")
    monkeypatch.setattr(predicates, "PUSHED_VALUES", 50)
    hits = Searcher(idx).hits(Fuzzy("text", "ab", 1, prefix=True))
    near = {"ab", "a", "b"}
    want = {i for i, w in enumerate(words) if w[0] in near or w[:2] in near or w[1] == "b" or w[1:3] == "ab" or w[:2] == "ba"}
    assert {r["doc_id"] for r in hits.collect()} == want
    assert _longest(hits) < COMPILED_BYTES
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        seen, write = [], batch_queries._written
        monkeypatch.setattr(batch_queries, "_written", lambda df, name: (seen.append(df) if name == "terms" else None, write(df, name))[1])
        rows = spark.createDataFrame([(i, w) for i, w in enumerate(words[:300:3])], "query_id long, text string")
        got: DataFrame = Searcher(idx).batch_query_strings(rows, ["text"], 1)
        assert sorted((r["query_id"], r["doc_id"]) for r in got.collect()) == [(i, 3 * i) for i in range(100)]
        assert _longest(seen[0]) < COMPILED_BYTES
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")

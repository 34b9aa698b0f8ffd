"""Top-k, hit counts, stored fields, and top-k per query."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_LIMIT = 10

# Scores are ranked at this many decimals, ties then go by doc_id: sums of
# the same partial scores taken in another order differ in the last bits,
# and that noise must not reorder equal documents (exact copies).
RANK_DECIMALS = 9


def rank_order():
    return [F.desc(F.round("score", RANK_DECIMALS)), F.asc("doc_id")]

def top_k(hits: DataFrame, k: int = DEFAULT_LIMIT) -> DataFrame:
    """Best k hits, descending score, ties by doc_id. Planned as
    TakeOrderedAndProject: each partition keeps k rows, the driver merges."""
    return hits.orderBy(*rank_order()).limit(k)


def top_k_per_query(hits: DataFrame, k: int = DEFAULT_LIMIT, key: str = "query_id",
                    spread: bool = True) -> DataFrame:
    """Best k hits of every query. `row_number() <= k` is rewritten by Spark
    into a partial per-partition group limit before the shuffle, so a query
    matching most of the corpus still ships at most k rows per partition.

    Without `spread` the hits must already be spread over (query, doc), as a
    sum by these two leaves them. If they arrived partitioned by query alone,
    the window would need no exchange, get no partial limit, and a query
    holding a third of all hits would be sorted in one task."""
    w = Window.partitionBy(key).orderBy(*rank_order())
    rows = hits.repartition(key, "doc_id") if spread else hits
    return (rows.withColumn("rank", F.row_number().over(w))
                .where(F.col("rank") <= k))


# Hits whose ids are brought to the driver to scan the corpus by.
PUSHED_HITS = 10_000
# Stored fields with a name of ours are returned under this prefix.
CLASH_PREFIX = "stored_"


def stored_name(field: str) -> str:
    return CLASH_PREFIX + field if field in ("doc_id", "score", "snippets") else field


def stored_fields(index, top: DataFrame, fields: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Attach stored fields to the top hits. A few hits (at most PUSHED_HITS)
    come to the driver, as the answer of the search they are, and the corpus,
    clustered on the id, is scanned by ranges of their ids. More hits stay on
    the executors and are joined there."""
    from quarry.operators.predicates import value_ranges
    stored = [f for f in (index.schema.stored_fields() if fields is None else fields) if f != index.id_col]
    corpus = index.corpus
    if limit is not None and limit <= PUSHED_HITS:
        rows = top.collect()
        top = index.spark.createDataFrame(rows, top.schema)
        corpus = corpus.where(value_ranges(f"`{index.id_col}`", [r["doc_id"] for r in rows]))
    return top.join(corpus.select(F.col(f"`{index.id_col}`").alias("doc_id"),
                                  *[F.col(f"`{f}`").alias(stored_name(f)) for f in stored]),
                    "doc_id", "left")

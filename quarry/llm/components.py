"""Connected components of a link table.

The links are dealt to tasks of about EDGES each; a task unites its own by
union-find and hands on one link a vertex, to the smallest vertex of its
piece. With one piece that is the answer. With more, a round of star
contraction on the whole table (each vertex's neighbours are linked to the
smallest of them) joins the pieces, and the next deal begins with fewer and
shorter links, until nothing changes.

Every round ends with a table in the shared folder, so a lost executor
repeats one round at most. A vertex with very many links is one key of a
minimum, with partial sums, and of a join that Spark may split. Nothing but
a row count and a checksum comes to the driver.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written

EDGES = 500_000          # links that a task unites


def _united(e: DataFrame) -> DataFrame:
    """Each partition's links (u, v) as links to the smallest vertex of a piece."""
    def run(batches):
        up: dict = {}

        def find(x):
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x, y = find(x), find(y)
                if x != y:
                    up[max(x, y)] = min(x, y)
        out = [(x, r) for x in up if (r := find(x)) != x]
        for i in range(0, len(out), 100_000):
            part = out[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([p[j] for p in part], kind) for j in (0, 1)], names=["u", "v"])
    return e.select("u", "v").mapInArrow(run, e.select("u", "v").schema)


def _star_round(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (both.where(F.col("v") > F.col("u")).join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    return (large.join(least, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame, a: str = "a", b: str = "b", per_task: int = EDGES) -> DataFrame:
    """(id, component): for each vertex with a link to another, the smallest
    vertex it can reach, itself included. Vertices without links are absent;
    null ends are ignored."""
    e = written(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                     .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), "edges")
    seen = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == seen or not now[0]:
            break
        pieces = math.ceil(now[0] / per_task)
        if pieces == 1:
            e = written(_united(e.repartition(1)), "edges")
            break
        seen = tuple(now)
        e = written(_star_round(_united(e.repartition(pieces, "v"))), "edges")
    return (e.select(F.col("u").alias("id"), F.col("v").alias("component"))
             .unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))

"""Embedding near-dedup by sorted projection passes (operator 1).

A vector's hash bits are the signs of its products with random directions;
near vectors agree in most bits. Each pass takes its own directions,
concatenates the bits, sorts all vectors by them over the whole table, and
compares each vector with the next WINDOW ones by cosine. Pairs that reach the
threshold are united across passes.

In a crowded place more than WINDOW strangers stand between the ends of a
pair. Runs of vectors that agree in a pass's first `prefix_bits` bits and are
longer than the window are therefore compared all against all, in blocks of
at most BLOCK against BLOCK; blocks that lie in one component already are left
out, and if the runs of all passes are more work than comparing every vector
that stands in one with every other, that is done instead. A pass so finds every
pair that agrees in these bits, which depends on the pair's angle alone: a pair
exactly at the threshold is missed by all passes with a chance of at most MISS,
however dense its surroundings are.

A window is too short for a large group of near copies, but chains of
neighbours connect the group all the same. The links of each vector are
therefore counted in the end against its whole component, exactly, in blocks
of at most BLOCK vectors against BLOCK: no pairs are written, only counts.

Equal vectors are one vertex from the start. Sorting is by range partition;
ranks come from the sizes of the sorted partitions, and the windows across
their borders from overlapping blocks of ranks, so a task never takes more
than a block.

Vectors that are null, empty or zero, or hold null or non-finite components,
link with nothing, as do vectors of another length (only vectors of equal
length are compared). A row without an id names no component: component_id
is null unless it is a copy of, or linked with, one that has an id, and kept
is false. Rows that repeat an id are one vertex. An empty table gives no rows.
Other columns, which may have any name, are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import tasks_for, written
from quarry.llm.components import components

THRESHOLD = 0.95
WINDOW = 64              # later neighbours in the order that a vector is compared with
BITS = 56                # hash bits of a pass, in one long
MISS = 1e-3
STEP = 1024              # ranks of a block; a block also holds the WINDOW ranks after it
BLOCK = 1024             # vectors of a component that are counted against as many at a time
SEED = 20240229


def passes_for(n: int, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes until a pair at the threshold is missed with a chance of at most
    `miss`: a pass finds it if its first `prefix_bits` bits agree."""
    agree = 1 - math.acos(threshold) / math.pi
    found = agree ** prefix_bits(n, window)
    return max(4, math.ceil(math.log(miss) / math.log(1 - min(found, 0.9))))


def prefix_bits(n: int, window: int = WINDOW) -> int:
    """Bits that vectors of a run agree in: were the bits fair, a run would be
    no longer than the window on average."""
    return min(BITS, max(1, math.ceil(math.log2(max(n, 2) / window))))


def _matrix(column) -> np.ndarray:
    """(rows, dimension) of a list column whose lists have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)          # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _directions(passes: int, dimension: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dimension, passes * BITS))


def _keys(vectors: DataFrame, passes: int) -> DataFrame:
    """(pass, key, rep, v): every vector once a pass."""
    def run(batches):
        drawn: dict[int, np.ndarray] = {}
        weight = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for b in batches:
            v = b.column(1)
            size = np.diff(v.offsets.to_numpy())
            for dim in np.unique(size).tolist():
                rows = np.flatnonzero(size == dim)
                if dim not in drawn:
                    drawn[dim] = _directions(passes, dim)
                for i in range(0, len(rows), 2048):
                    part = b.take(pa.array(rows[i:i + 2048]))
                    bits = (_matrix(part.column(1)) @ drawn[dim]) > 0
                    for p in range(passes):
                        key = bits[:, p * BITS:(p + 1) * BITS] @ weight
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(key), p, np.int32)), pa.array(key), *part.columns],
                            names=["pass", "key", "rep", "v"])
    return vectors.select("rep", "v").mapInArrow(run, T.StructType([
        T.StructField("pass", T.IntegerType()), T.StructField("key", T.LongType()),
        vectors.schema["rep"], vectors.schema["v"]]))


def _forest(ids: np.ndarray, rows: np.ndarray, cols: np.ndarray):
    """A spanning forest of the links rows[i] - cols[i]."""
    label = np.arange(len(ids))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for r, c in zip(rows.tolist(), cols.tolist()):
        a, b = find(r), find(c)
        if a != b:
            label[max(a, b)] = min(a, b)
            yield ids[r], ids[c]


def _window_links(blocks: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links between ranks at most WINDOW apart. `blocks`: (block,
    rank, rep, v), of which each task takes whole blocks."""
    def close(parts):
        t = pa.Table.from_batches(parts).combine_chunks()
        v = t.column("v").chunk(0)
        size = np.diff(v.offsets.to_numpy())
        rank = t.column("rank").to_numpy()
        rep = t.column("rep").to_numpy()
        for dim in np.unique(size).tolist():
            rows = np.flatnonzero(size == dim)
            rows = rows[np.argsort(rank[rows], kind="stable")]
            x = _unit(_matrix(v.take(pa.array(rows))))
            near = x @ x.T >= threshold
            i, j = np.nonzero(np.triu(near, 1))
            close_by = rank[rows[j]] - rank[rows[i]] <= WINDOW
            yield from _forest(rep[rows], i[close_by], j[close_by])

    def run(batches):
        held, block, a, b = [], None, [], []

        def flush():
            for x, y in close(held):
                a.append(x), b.append(y)

        for batch in batches:
            names = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(names)) + 1).tolist(), len(names)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if held and names[i] != block:
                    flush()
                    held = []
                block = names[i]
                held.append(batch.slice(i, j - i))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a, b = [], []
        if held:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    src = (blocks.select("block", "rank", "rep", "v").repartition(tasks_for(blocks.sparkSession), "block")
                 .sortWithinPartitions("block"))
    return src.mapInArrow(run, "a long, b long")


def _ranked(rows: DataFrame, *order: str) -> DataFrame:
    """`rows` with `rank`, the place of each row in the order of these columns.
    The sorted table is written; ranks come from its rows' places within a
    partition and the partitions' sizes (a row a partition)."""
    spark = rows.sparkSession
    sorted_ = written(rows.repartitionByRange(tasks_for(spark), *order)
                          .sortWithinPartitions(*order)
                          .withColumn("at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("at", 33).alias("part")
    before, sizes = 0, []
    for r in sorted_.groupBy(part).count().orderBy("part").collect():
        sizes.append((r["part"], before))
        before += r["count"]
    starts = spark.createDataFrame(sizes or [(0, 0)], "part long, start long")
    return (sorted_.withColumn("part", part).join(F.broadcast(starts), "part")
                   .select((F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("rank"), *rows.columns))


def _run_links(keys: DataFrame, reps: DataFrame, found: DataFrame, bits: int, threshold: float) -> DataFrame | None:
    """(a, b): links between components, of vectors that agree in the first
    `bits` bits of a pass and stand in a run longer than the window; None if no
    run is. `keys`: (pass, key, rep); `found`: (rep, component)."""
    spark, run = keys.sparkSession, ["pass", "prefix"]
    keys = keys.select("pass", F.shiftright("key", BITS - bits).alias("prefix"), "rep")
    runs = written(keys.groupBy(run).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WINDOW + 1), "runs")
    work = runs.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0]
    if work is None:
        return None
    crowd = written(keys.join(runs, run).select(*run, "rep"), "crowd")
    once = crowd.select("rep").distinct()
    if work > float(once.count()) ** 2:
        crowd = once.select(F.lit(0).alias("pass"), F.lit(0).cast("long").alias("prefix"), "rep")
    # in the order of components, so that most blocks of a large one hold nothing else
    ranked = _ranked(crowd.join(found, "rep", "left").select(*run, F.coalesce("component", "rep").alias("component"), "rep"),
                     *run, "component", "rep")
    starts = written(ranked.groupBy(run).agg(F.min("rank").alias("start")), "starts")
    placed = written(ranked.join(starts, run).select(
        *run, F.floor((F.col("rank") - F.col("start")) / BLOCK).alias("block"), "component", "rep"), "placed")
    blocks = written(placed.groupBy(*run, "block").agg(F.min("component").alias("lo"), F.max("component").alias("hi")), "blocks")
    x = blocks.select(*run, F.col("block").alias("x"), F.col("lo").alias("xlo"), F.col("hi").alias("xhi"))
    y = blocks.select(*run, F.col("block").alias("y"), "lo", "hi")
    pairs = written(x.join(y, run).where((F.col("x") <= F.col("y")) & (F.least("xlo", "lo") != F.greatest("xhi", "hi")))
                     .select(*run, "x", "y"), "blockpairs")
    cols = [*run, "x", "y"]
    asks = placed.withColumnRenamed("block", "x").join(pairs, [*run, "x"]).select(*cols, F.lit(True).alias("asks"), "component", "rep")
    answers = (placed.withColumnRenamed("block", "y").join(pairs.where("x < y"), [*run, "y"])
                     .select(*cols, F.lit(False).alias("asks"), "component", "rep"))
    src = (asks.unionByName(answers).join(reps.select("rep", "v"), "rep").withColumn("grp", F.xxhash64(*cols))
               .repartition(tasks_for(spark), "grp").sortWithinPartitions("grp", *cols)
               .select(*cols, "asks", "component", "rep", "v"))

    def close(parts):
        t = pa.Table.from_batches(parts).combine_chunks()
        asks = t.column("asks").to_numpy()
        component, rep = t.column("component").to_numpy(), t.column("rep").to_numpy()
        v = t.column("v").chunk(0)
        size = np.diff(v.offsets.to_numpy())
        for dim in np.unique(size).tolist():
            q = np.flatnonzero(asks & (size == dim))
            r = q if asks.all() else np.flatnonzero(~asks & (size == dim))
            if len(q) and len(r):
                near = _unit(_matrix(v.take(pa.array(q)))) @ _unit(_matrix(v.take(pa.array(r)))).T >= threshold
                i, j = np.nonzero(near & (component[q][:, None] != component[r][None, :]))
                yield from _forest(rep, q[i], r[j])

    def links(parts):
        out = list(close(parts)) if parts else []
        return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                           pa.array([o[1] for o in out], pa.int64())], names=["a", "b"])

    def compare(batches):
        held, key = [], None
        for b in batches:
            names = np.stack([b.column(i).to_numpy() for i in range(4)], axis=1)
            cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist(), len(names)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                now = tuple(names[i].tolist())
                if held and now != key:
                    yield links(held)
                    held = []
                key = now
                held.append(b.slice(i, j - i))
        yield links(held)

    return src.mapInArrow(compare, "a long, b long")


def _link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(rep, links, size): the weight of the members of its component that
    each member links with, itself included. `members`: (component, rep, v, weight)."""
    spark = members.sparkSession
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    # rows ask in their own block against each block, and answer all blocks
    asks = placed.select("component", F.col("own").alias("x"), F.explode(every).alias("y"), F.lit(True).alias("asks"), "rep", "v", "weight")
    answers = placed.select("component", F.explode(every).alias("x"), F.col("own").alias("y"), F.lit(False).alias("asks"), "rep", "v", "weight")
    src = (asks.unionByName(answers).withColumn("grp", F.xxhash64("component", "x", "y"))
               .repartition(tasks_for(spark), "grp").sortWithinPartitions("grp", "component", "x", "y")
               .select("component", "x", "y", "asks", "rep", "v", "weight"))

    def close(parts):
        t = pa.Table.from_batches(parts).combine_chunks()
        asks = t.column("asks").to_numpy(zero_copy_only=False)
        weight, rep = t.column("weight").to_numpy(), t.column("rep").to_numpy()
        v = t.column("v").chunk(0)
        size = np.diff(v.offsets.to_numpy())
        for dim in np.unique(size).tolist():
            q, r = np.flatnonzero(asks & (size == dim)), np.flatnonzero(~asks & (size == dim))
            if len(q) and len(r):
                near = _unit(_matrix(v.take(pa.array(q)))) @ _unit(_matrix(v.take(pa.array(r)))).T >= threshold
                # a vector always agrees with itself, whatever rounding says
                near |= rep[q][:, None] == rep[r][None, :]
                yield from zip(rep[q].tolist(), (near @ weight[r]).tolist())

    def run(batches):
        held, key, out = [], None, []
        for b in batches:
            names = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist(), len(names)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                now = tuple(names[i].tolist())
                if held and now != key:
                    out += close(held)
                    held = []
                key = now
                held.append(b.slice(i, j - i))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                              pa.array([o[1] for o in out], pa.int64())], names=["rep", "links"])
            out = []
        if held:
            out = list(close(held))
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                          pa.array([o[1] for o in out], pa.int64())], names=["rep", "links"])

    return src.mapInArrow(run, "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept). Ids are integers."""
    v = F.col(vector_col).cast("array<double>")
    good = (F.coalesce(F.size(v) > 0, F.lit(False)) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
            & F.exists(v, lambda x: x != 0))
    # -0.0 and 0.0 are one value
    base = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.when(F.coalesce(good, F.lit(False)), F.transform(v, lambda x: x + 0.0)).alias("v"))
    digest = F.when(F.col("v").isNotNull(), F.md5(F.to_json(F.struct("v")).cast("binary")))
    base = written(base.withColumn("digest", digest), "vectors")
    reps = written(base.where("digest is not null").groupBy("digest")
                       .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.any_value("v").alias("v"))
                       .where(F.col("rep").isNotNull()), "reps")
    n = reps.count()
    ranked = _ranked(_keys(reps, passes_for(n, threshold)), "pass", "key", "rep")
    block = F.floor(F.col("rank") / STEP)
    blocks = ranked.select(F.explode(F.when((F.col("rank") % STEP < WINDOW) & (F.col("rank") >= STEP),
                                            F.array(block - 1, block)).otherwise(F.array(block))).alias("block"),
                           "rank", "rep", "v")
    pairs = written(_window_links(blocks, threshold), "pairs")
    united = lambda e: written(components(e).select(F.col("id").alias("rep"), F.col("component")), "components")
    found = united(pairs)
    more = _run_links(ranked, reps, found, prefix_bits(n), threshold)
    if more is not None:
        found = united(pairs.unionByName(written(more, "runlinks")))
    counts = _link_counts(reps.join(found, "rep").select("component", "rep", "v", "weight"), threshold)
    rows = (reps.select("digest", "rep", "weight").join(found, "rep", "left").join(counts, "rep", "left")
                .select("digest", F.coalesce("component", "rep").alias("component_id"),
                        (F.coalesce("links", "weight") - 1).alias("n_links")))
    return base.drop("v").join(rows, "digest", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"))

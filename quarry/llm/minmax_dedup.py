"""MinHash near-dedup with min-max signatures (operator 5).

Each hash permutation gives two signature values, the smallest and the
largest hash of a document's shingle set, so a signature of 2p values costs
p evaluations per shingle. Each agrees between two sets with a chance equal
to their Jaccard similarity. Bands of these values bring candidates
together; links are confirmed on the full sets, and components are the
classes.

How the work is bounded:
  * documents with the same set are one vertex from the start;
  * a bucket of a band links its members to its smallest one only, which
    gives candidate clusters (not yet links);
  * a cluster is verified in blocks of at most BLOCK documents, all pairs of
    a block in one task on sorted hash arrays; only a spanning forest of
    the links leaves the task. In a cluster of several blocks every block
    also gets the same PIVOTS documents, so most of a large group joins up
    at once;
  * documents of such a cluster that are still outside its largest class
    are then dealt to blocks of their own, which are compared with all blocks
    of the cluster, so no block border loses a link.

Only candidates sharing a band are found: with `bands_for`, a pair exactly
at the threshold is missed with a chance below MISS, a closer one far less.

Nulls: a null or wordless text has an empty set and links with nothing. A
row without an id is looked up by its set, but names no class: it is kept if
its class has no id. A vertex is a set, named by its smallest id and its
digest, so rows that repeat an id with different texts are different vertices.
Ties of ids go to the smaller digest. Very long texts are hashed in slices and
whole; empty tables give no rows; of other columns, which may have any name,
none is read (`deduplicated` carries them along).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import slices, strings, tasks_for, written
from quarry.llm.components import components
from quarry.llm.shingles import mix, shingle_hashes

ROWS = 6                # signature values in a band: 3 permutations, both ends
MISS = 2e-5             # chance to miss a pair exactly at the threshold
BLOCK = 128             # documents that are compared with one another in a task
PIVOTS = 8              # documents that all blocks of a large cluster share
SLICE_BYTES = 1 << 19   # text that is hashed at once

_RNG = np.random.default_rng(77)
_FACTORS = _RNG.integers(0, 2 ** 63, 4096, np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RNG.integers(0, 2 ** 64, 4096, np.uint64)


def bands_for(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands with which a pair at the threshold shares none with a chance under `miss`.

    Of n shingles in either set, m in both, a permutation's smallest and largest
    are both shared with a chance of m (m - 1) / (n (n - 1)), which is less than
    (m / n)^2 and least for small sets; with n it goes to threshold^2."""
    both = threshold ** 2
    for n in range(2, 1000):
        m = math.ceil(threshold * n - 1e-9)
        if m < n:
            both = min(both, m * (m - 1) / (n * (n - 1)))
    return math.ceil(math.log(miss) / math.log(1 - both ** (rows // 2)))


def signatures(h: np.ndarray, at: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    """(texts, bands): a 64-bit key of each band, from the smallest and the
    largest value of rows/2 permutations of the hashes h[at[i]:at[i+1]]."""
    keys = np.zeros((len(at) - 1, bands), np.uint64)
    x = np.empty_like(h)
    starts = at[:-1]
    for p in range(bands * rows // 2):
        np.multiply(h, _FACTORS[p], out=x)
        x += _TERMS[p]
        band = p // (rows // 2)
        for end in (np.minimum, np.maximum):
            keys[:, band] = mix(keys[:, band] * np.uint64(31) + end.reduceat(x, starts))
    return keys + mix(np.arange(1, bands + 1, dtype=np.uint64))


def sketch(docs: DataFrame, k: int, bands: int) -> DataFrame:
    """(id, tid, n_shingles, set_digest, bands) of docs (id, tid, text): digest and bands are null for an empty set."""
    def run(batches):
        for b in batches:
            data, off = strings(b.column(2))
            n, digest, sig = [], [], []
            for i, j in slices(off, SLICE_BYTES):
                h, at = shingle_hashes(data, off[i:j + 1], k)
                full = np.flatnonzero(np.diff(at))
                keys = (signatures(h, np.r_[at[full], len(h)], bands).view(np.int64)
                        if len(full) else None)
                row = 0
                for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
                    if s == e:
                        n.append(0), digest.append(None), sig.append(None)
                        continue
                    u = np.unique(h[s:e])
                    n.append(len(u))
                    digest.append(hashlib.blake2b(u.tobytes(), digest_size=16).digest())
                    sig.append(keys[row])
                    row += 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(sig, pa.list_(pa.int64()))], names=["id", "tid", "n_shingles", "set_digest", "bands"])

    src = docs.select("id", "tid", "text")
    return src.mapInArrow(run, T.StructType([
        src.schema["id"], T.StructField("tid", T.LongType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("set_digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]))


def _links(ids: list, sets: list[np.ndarray], num: int, den: int):
    """A spanning forest of the links of one block: den * |a & b| >= num * |a | b|."""
    sizes = np.array([len(s) for s in sets])
    flat, code = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    label = np.arange(len(ids))
    flags = np.zeros(len(flat), bool)
    for i in range(len(ids) - 1):
        if (label == label[0]).all():
            return
        own = code[starts[i]:starts[i] + sizes[i]]
        flags[own] = True
        both = np.add.reduceat(flags[code], starts, dtype=np.int64)
        flags[own] = False
        near = np.flatnonzero(den * both >= num * (sizes[i] + sizes - both))
        for j in near.tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                yield ids[i], ids[j]


def confirmed(members: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(a, b): links within groups of `members` (grp binary, id, text), as a
    spanning forest of each group. Groups are bounded by the caller."""
    def run(batches):
        def close(ids, texts):
            data, off = strings(pa.array(texts, pa.string()))
            h, at = shingle_hashes(data, off, k)
            sets = [np.unique(h[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            full = [i for i, s in enumerate(sets) if len(s)]
            return _links([ids[i] for i in full], [sets[i] for i in full], num, den) if len(full) > 1 else ()

        a, b, grp, ids, texts = [], [], None, [], []

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], names=["a", "b"])
            a.clear(), b.clear()
            return batch

        for batch in batches:
            for g, i, t in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if g != grp:
                    for x, y in close(ids, texts) if len(ids) > 1 else ():
                        a.append(x), b.append(y)
                    grp, ids, texts = g, [], []
                ids.append(i), texts.append(t)
            yield out()
        for x, y in close(ids, texts) if len(ids) > 1 else ():
            a.append(x), b.append(y)
        yield out()

    spark, id_type = members.sparkSession, members.schema["id"].dataType
    kind = pa.int64() if id_type == T.LongType() else pa.int32() if id_type == T.IntegerType() else pa.string()
    src = (members.select("grp", "id", "text").repartition(tasks_for(spark), "grp")
                  .sortWithinPartitions("grp"))
    return src.mapInArrow(run, T.StructType([T.StructField("a", id_type), T.StructField("b", id_type)]))


def _group(*cols):
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))



def _vertex(kind: T.DataType) -> Column:
    """A name of a set that sorts as its smallest id: the id, then the digest."""
    if isinstance(kind, T.IntegralType):
        ahead = (F.col("id").cast("decimal(20,0)") + F.lit(str(2 ** 63)).cast("decimal(20,0)")).cast("decimal(20,0)")
        return F.concat(F.lpad(ahead.cast("string"), 20, "0"), F.lit(":"), F.lower(F.hex("set_digest")))
    return F.concat(F.col("id").cast("string"), F.lit("\0"), F.lower(F.hex("set_digest")))


def _id_of(vertex: str, kind: T.DataType) -> Column:
    own = F.col(vertex)
    if isinstance(kind, T.IntegralType):
        return (F.substring(own, 1, 20).cast("decimal(20,0)") - F.lit(str(2 ** 63)).cast("decimal(20,0)")).cast(kind)
    return F.substr(own, F.lit(1), F.length(own) - 33).cast(kind)


def _classes(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Of docs (id, tid, text): the rows (id, tid, n_shingles, set_digest), and
    for each set (set_digest, id, tid, rep, class), the names of its vertex
    and of the smallest one reachable."""
    bands, kind = bands_for(num / den), docs.schema["id"].dataType
    base = written(sketch(docs, k, bands), "sketch")
    named = F.when(F.col("id").isNotNull(), F.struct("id", "tid"))
    reps = (base.where(F.col("set_digest").isNotNull()).groupBy("set_digest")
                .agg(F.min(named).alias("first"), F.any_value("bands").alias("bands"))
                .where(F.col("first").isNotNull()).select("set_digest", "first.id", "first.tid", "bands"))
    reps = written(reps.withColumn("rep", _vertex(kind)), "reps")
    keyed = reps.select("rep", F.explode("bands").alias("key"))
    buckets = (keyed.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most"))
                    .where(F.col("least") != F.col("most")))
    near = (keyed.join(buckets, "key").where(F.col("rep") != F.col("least"))
                 .select(F.col("rep").alias("a"), F.col("least").alias("b")).distinct())
    cluster = components(near).withColumnRenamed("id", "rep")
    h = [F.xxhash64(F.col("rep"), F.lit(j)) for j in range(PIVOTS)]
    sizes = cluster.groupBy("component").agg(
        F.count(F.lit(1)).alias("size"),
        F.array_distinct(F.array(*[F.min_by("rep", x) for x in h])).alias("pivots"))
    placed = (cluster.join(sizes, "component")
              .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
              .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
              .withColumn("pivot", F.array_contains("pivots", F.col("rep"))).drop("pivots"))
    # the texts of documents in clusters, fetched once (a row that is there
    # twice gives the same text)
    wanted = placed.join(reps.select("rep", "id", "tid"), "rep")
    members = written(docs.join(wanted.hint("merge"), ["id", "tid"]).drop("id", "tid").dropDuplicates(["rep"]), "members")
    own = members.select("component", "rep", "text", "block", "blocks")
    shared = (members.where("pivot and blocks > 1")
              .select("component", "rep", "text",
                      F.explode(F.expr("filter(sequence(0, blocks - 1), x -> x != block)")).alias("block"),
                      "blocks"))
    edges = written(confirmed(
        own.unionByName(shared).select(_group(F.col("component"), F.col("block")).alias("grp"),
                                       F.col("rep").alias("id"), "text"), k, num, den), "links")
    across = _across_blocks(members.where("blocks > 1"), edges)
    edges = edges.unionByName(written(confirmed(across, k, num, den), "links"))
    found = components(edges).withColumnRenamed("id", "rep").withColumnRenamed("component", "class")
    classes = (reps.drop("bands").join(found, "rep", "left").withColumn("class", F.coalesce("class", "rep")))
    return base.drop("bands"), classes


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tid, text): `tid`, a hash of the text, tells rows of one id apart."""
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("tid"), F.col(f"`{text_col}`").alias("text"))


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id, kept).

    Documents whose k-word shingle sets have a Jaccard similarity of num/den
    or more are linked; component_id is the smallest id reachable by links.
    """
    src = _keyed(docs, id_col, text_col)
    base, classes = _classes(src, k, num, den)
    known = classes.select("set_digest", _id_of("class", src.schema["id"].dataType).alias("class"))
    return (base.drop("tid").join(known, "set_digest", "left")
                .select(F.col("id").alias("doc_id"), "n_shingles",
                        F.coalesce("class", "id").alias("component_id"))
                .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"),
                                               F.col("component_id").isNull())))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One document of each class, with its columns: the one with the smallest
    id (of rows that repeat it, the one whose set names the class). Of rows
    with the same id and text one is kept. Rows without an id cannot be told
    apart by it and stay."""
    named = docs.where(F.col(f"`{id_col}`").isNotNull())
    base, classes = _classes(_keyed(named, id_col, text_col), k, num, den)
    kept = (classes.where(F.col("rep") == F.col("class")).select("id", "tid")
                   .unionByName(base.where(F.col("set_digest").isNull()).select("id", "tid")).distinct())
    rows = named.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"),
                        F.xxhash64(F.col(f"`{text_col}`")).alias("tid"))
    one = rows.join(kept, ["id", "tid"], "left_semi").dropDuplicates(["id", "tid"])
    return (one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
               .unionByName(docs.where(F.col(f"`{id_col}`").isNull())))


def _across_blocks(members: DataFrame, edges: DataFrame) -> DataFrame:
    """(grp, id, text): what is left to compare in clusters of several
    blocks. Documents outside their cluster's largest class so far are dealt
    to blocks of their own, and each of these meets each block of the
    cluster; a cluster that is one class has none."""
    so_far = components(edges).select(F.col("id").alias("rep"), F.col("component").alias("class"))
    state = written(members.select("component", "rep").distinct().join(so_far, "rep", "left")
                           .withColumn("class", F.coalesce("class", "rep")), "state")
    per_class = state.groupBy("component", "class").agg(F.count(F.lit(1)).alias("n"))
    left = (per_class.groupBy("component").agg(F.max_by("class", "n").alias("main"),
                                               (F.sum("n") - F.max("n")).alias("outside"))
                     .where("outside > 0")
                     .withColumn("asking", F.ceil(F.col("outside") / BLOCK).cast("int")))
    todo = members.join(state, ["component", "rep"]).join(left, "component")
    answers = todo.select("component", "rep", "text", "block",
                          F.explode(F.expr("sequence(0, asking - 1)")).alias("ask"))
    asks = (todo.where("class != main")
                .select("component", "rep", "text", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
                        F.expr("cast(pmod(xxhash64(rep, 1), asking) as int)").alias("ask")))
    return answers.unionByName(asks).select(
        _group(F.col("component"), F.col("block"), F.col("ask")).alias("grp"), F.col("rep").alias("id"), "text")

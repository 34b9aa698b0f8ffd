"""Merkle manifest of a document table, proved leaf by leaf with a recursive query.

Every row is a leaf: the SHA-256 of its columns, each as byte count, colon and
value, or `-` if null. The leaves of a language, by ascending id, are hashed
in runs of eight, level by level, to a subroot; the subroots, ordered by
language (null first), are hashed likewise to the root.

The built levels are stored as node rows that link to their parent: (tree,
step, block, up, kids), where `kids` holds the run that the node was made of
and (tree, step + 1, up) is the parent's row. A recursive query climbs from
all leaves at once: each step joins the rows of the last one with their
parents, appends the other members of the run, and folds the leaf's hash into
the next one. The node of a step is stored once for each block of up to
8^BLOCK_LEVELS leaves below it, so no key of that join stands for more leaves
than that, the root's included, and the copies are few (a row a block and level).

Places are found without gathering a language: leaves are range-partitioned
and sorted, and a row's place is its place in the partition plus the counts of
the language in earlier ones.

Rows that repeat an id are leaves of their own, in order of their hash (equal
ones are alike). A null id sorts first and is never tampered with. Null and
empty texts differ (`-` and `0:`). A lone leaf is its language's subroot, a
lone subroot the root; its proof is the hash of nothing. An empty table gives
no rows. Texts of any length are hashed whole, inside the row. Only the named
columns are read, so others may have any name.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, tasks_for, written

# Members of a run, as a power of two.
FAN_BITS = 3
FAN = 1 << FAN_BITS
# A node above this level is stored once for each block of 8^4 = 4096 leaves.
BLOCK_LEVELS = 4
# Levels that a count of 64 bits can need.
MOST_LEVELS = 21


def _part(c: Column) -> Column:
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_hash(text: Column | None = None) -> Column:
    """The leaf of a row, 32 bytes; `text` in place of the column's own."""
    parts = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text") if text is None else text]
    return F.unhex(F.sha2(F.concat(*[_part(c) for c in parts]), 256))


def _hashed(packed: Column) -> Column:
    """H of digests packed one after the other: their hex text is hashed."""
    return F.unhex(F.sha2(F.lower(F.hex(packed)), 256))


def _height(n: Column) -> Column:
    """Levels above n nodes: the smallest h with 8^h >= n."""
    return sum((F.when(n > F.lit(FAN ** k), 1).otherwise(0) for k in range(MOST_LEVELS)), F.lit(0))


def placed(docs: DataFrame) -> DataFrame:
    """(tree, pos, n, h, doc_id, leaf, tampered): every leaf with its place.

    tree: rank of its language; pos: place in it; n: leaves of the language;
    h: levels above them; tampered: the leaf after tampering, where that is due.
    """
    spark = docs.sparkSession
    due = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = written(docs.select("doc_id", "lang", leaf_hash().alias("leaf"),
                                 F.when(due, leaf_hash(ascii_lower("text"))).alias("changed")), "merkle-leaves")
    order = ["lang", "doc_id", "leaf"]
    rows = written(leaves.repartitionByRange(tasks_for(spark), *order).sortWithinPartitions(*order)
                         .withColumn("at", F.monotonically_increasing_id()), "merkle-ordered")
    rows = rows.withColumn("pid", F.shiftright("at", 33))
    # one row a language and partition: where it starts there, what came before
    before = Window.partitionBy("lang").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = (rows.groupBy("pid", "lang").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("here"))
                .withColumn("before", F.coalesce(F.sum("here").over(before), F.lit(0))))
    runs = written(runs, "merkle-runs")
    # languages are numbered in their order from the partitions they begin in
    heads = runs.where("before = 0").select("pid", "lang", F.row_number().over(
        Window.partitionBy("pid").orderBy("lang")).alias("nth"))
    earlier = (heads.groupBy("pid").agg(F.count(F.lit(1)).alias("new"))
                    .select("pid", (F.sum("new").over(Window.orderBy("pid")) - F.col("new")).alias("ahead")))
    total = runs.groupBy(F.col("lang").alias("l")).agg(F.sum("here").alias("n"))
    trees = heads.join(earlier, "pid").join(total, F.col("lang").eqNullSafe(F.col("l"))).select(
        "lang", (F.col("ahead") + F.col("nth") - 1).alias("tree"), "n", _height(F.col("n")).alias("h"))
    spot = runs.alias("r").join(trees.alias("t"), F.col("r.lang").eqNullSafe(F.col("t.lang"))).select(
        F.col("r.pid").alias("p"), F.col("r.lang").alias("l"), "first", "before", "tree", "n", "h")
    spot = written(spot, "merkle-spots")
    return written(rows.join(spot, (F.col("pid") == F.col("p")) & F.col("lang").eqNullSafe(F.col("l"))).select(
        "tree", (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "n", "h", "doc_id", "leaf",
        F.coalesce("changed", "leaf").alias("tampered")), "merkle-placed")


def _levels(level: DataFrame, most: int, name: str) -> list[DataFrame]:
    """The levels above (tree, idx, n, digest), where n nodes of a tree are on
    that level: (tree, idx, n, kids, digest), one table a level."""
    out = []
    while most > 1:
        run = F.sort_array(F.collect_list(F.struct("idx", "digest")))
        kids = F.unhex(F.array_join(F.transform(run, lambda x: F.hex(x.digest)), ""))
        level = written(level.where("n > 1").groupBy("tree", F.shiftright("idx", FAN_BITS).alias("idx"))
                             .agg(F.first("n").alias("n"), kids.alias("kids"))
                             .select("tree", "idx", F.shiftright(F.col("n") + (FAN - 1), FAN_BITS).alias("n"), "kids",
                                     _hashed(F.col("kids")).alias("digest")), f"merkle-{name}")
        out.append(level)
        most = -(-most // FAN)
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def manifest(leaves: DataFrame) -> tuple[DataFrame, DataFrame, bytes | None]:
    """(nodes, subroots, root) over the leaves `placed` found."""
    spark = leaves.sparkSession
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels = _levels(leaves.select("tree", F.col("pos").alias("idx"), "n", F.col("leaf").alias("digest")), most, "level")
    tops = [leaves.where("n = 1").select("tree", F.col("leaf").alias("subroot"))]
    tops += [x.where("n = 1").select("tree", F.col("digest").alias("subroot")) for x in levels]
    per_tree = leaves.where("pos = 0").select("tree", F.col("n").alias("leaves"), "h")
    subroots = written(_union(tops).join(per_tree, "tree"), "merkle-subroots")
    count = subroots.count()
    upper = _levels(subroots.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("idx"),
                                    F.lit(count).cast("long").alias("n"), F.col("subroot").alias("digest")), count, "upper")
    top = upper[-1].select("digest") if upper else subroots.select("subroot")
    root = top.first()

    def last(step: Column) -> Column:
        """Number of the last block of a tree's leaves that a step's keys tell apart."""
        width = F.least(step, F.lit(BLOCK_LEVELS)) * FAN_BITS
        return F.call_function("shiftright", F.col("leaves") - 1, width.cast("int"))

    parts = []
    for k, x in enumerate(levels, 1):
        # the node's own blocks, up to the last one of the tree
        wide = FAN_BITS * max(k - BLOCK_LEVELS, 0)
        low = F.shiftleft("idx", wide)
        high = F.least(low + F.lit((1 << wide) - 1), last(F.lit(k)))
        parts.append(x.join(per_tree, "tree").select("tree", F.lit(k).alias("step"), F.explode(F.sequence(low, high)).alias("block"), "kids"))
    for j, x in enumerate(upper, 1):
        mine = per_tree.withColumn("idx", F.shiftright("tree", FAN_BITS * j)).withColumn("step", F.col("h") + j)
        parts.append(mine.join(x.select("idx", "kids"), "idx").select(
            "tree", "step", F.explode(F.sequence(F.lit(0).cast("long"), last(F.col("step")))).alias("block"), "kids"))
    if not parts:
        nodes = spark.createDataFrame([], "tree long, step int, block long, kids binary")
    else:
        nodes = _union(parts)
    up = F.when(F.col("step") < BLOCK_LEVELS, F.shiftright("block", FAN_BITS)).otherwise(F.col("block"))
    return written(nodes.withColumn("up", up), "merkle-nodes"), subroots, bytes(root[0]) if root else None


@contextmanager
def _unlimited_recursion(spark: SparkSession):
    """Spark stops a recursive query at a million rows; one row a leaf and
    level is what this one is for."""
    key = "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, old)


# A climb: `place` is the row's place in the run of its next node. The first
# step is made where the climb starts; what is found there is the leaf and
# then its siblings, on later steps the siblings alone.
_BESIDE = "concat(substring(kids, 1, 32 * place), substring(kids, 32 * place + 33))"
_FOLD = "unhex(sha2(lower(hex(concat(substring(kids, 1, 32 * place), folded, substring(kids, 32 * place + 33)))), 256))"
_PLACE = f"""CAST(CASE WHEN n.step <= c.h THEN shiftright(c.pos, {FAN_BITS} * (n.step - 1))
                 ELSE shiftright(c.tree, {FAN_BITS} * (n.step - c.h - 1)) END & {FAN - 1} AS int) AS place"""
CLIMB = f"""
WITH RECURSIVE climb(tree, pos, h, doc_id, step, up, found, folded) AS (
  SELECT tree, pos, h, doc_id, step, up, coalesce(concat(leaf, {_BESIDE}), leaf) AS found, coalesce({_FOLD}, folded) AS folded
  FROM (SELECT c.tree, c.pos, c.h, c.doc_id, 1 AS step, n.up, n.kids, c.leaf, c.tampered AS folded, {_PLACE}
        FROM {{leaves}} c LEFT JOIN {{nodes}} n ON n.tree = c.tree AND n.step = 1 AND n.block = shiftright(c.pos, {FAN_BITS}))
  UNION ALL
  SELECT tree, pos, h, doc_id, step, up, {_BESIDE} AS found, {_FOLD} AS folded
  FROM (SELECT c.tree, c.pos, c.h, c.doc_id, n.step, n.up, n.kids, c.folded, {_PLACE}
        FROM climb c JOIN {{nodes}} n ON n.tree = c.tree AND n.step = c.step + 1 AND n.block = c.up)
)
SELECT tree, pos, doc_id, step, found, folded FROM climb
"""


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def proofs(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), a row a document."""
    spark = docs.sparkSession
    leaves = placed(docs)
    nodes, subroots, root = manifest(leaves)
    climb = spark.sql(CLIMB, leaves=leaves, nodes=nodes)
    path = (climb.groupBy("tree", "pos", "doc_id")
                 .agg(F.sort_array(F.collect_list(F.struct("step", "found"))).alias("path"),
                      F.max_by("folded", "step").alias("folded")))
    beside = F.substr(F.array_join(F.transform("path", lambda x: F.lower(F.hex(x.found))), ""), F.lit(65))
    root = F.lit(None if root is None else root.hex()).cast("string")
    rows = path.join(subroots.select("tree", "subroot"), "tree").select(
        "doc_id", F.substring(_text(F.col("path")[0].found), 1, 64).alias("leaf"), _text(F.col("subroot")).alias("subroot"), root.alias("root"),
        F.sha2(beside, 256).alias("proof_sha256"), _text(F.col("folded")).alias("folded_root"),
        (_text(F.col("folded")) == root).alias("verified"))
    with _unlimited_recursion(spark):
        return written(rows, "merkle-proofs")


# crc32 of the decimal id, bit by bit (the polynomial is a fixed value).
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


def _sql_part(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_sql_part, ("doc_id", "source", "lang", "n_chars", text))) + ")"


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_sql_leaf('text')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_CRC} % 3 = 0 THEN {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents),
p AS (SELECT *, coalesce(lang, '') || CASE WHEN lang IS NULL THEN '0' ELSE '1' END AS tree,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
lv(tree, step, idx, n, h) AS (
  SELECT tree, 0, pos, n, leaf FROM p
  UNION ALL
  SELECT tree, any_value(step) + 1, idx // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM lv WHERE n > 1 GROUP BY tree, idx // 8),
sub AS (SELECT lang, tree, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS n
        FROM lv JOIN (SELECT DISTINCT lang, tree FROM p) USING (tree) WHERE n = 1),
uv(step, idx, n, h) AS (
  SELECT 0, r, n, h FROM sub
  UNION ALL
  SELECT any_value(step) + 1, idx // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM uv WHERE n > 1 GROUP BY idx // 8),
c1(tree, pos, step, spot, n, proof, folded) AS (
  SELECT tree, pos, 0, pos, n, '', coalesce(changed, leaf) FROM p
  UNION ALL
  SELECT c.tree, c.pos, any_value(c.step) + 1, any_value(c.spot) // 8, (any_value(c.n) + 7) // 8,
         any_value(c.proof) || coalesce(string_agg(lv.h, '' ORDER BY lv.idx) FILTER (lv.idx <> c.spot), ''),
         sha256(string_agg(CASE WHEN lv.idx = c.spot THEN c.folded ELSE lv.h END, '' ORDER BY lv.idx))
  FROM c1 c JOIN lv ON lv.tree = c.tree AND lv.step = c.step AND lv.idx // 8 = c.spot // 8
  WHERE c.n > 1 GROUP BY c.tree, c.pos),
c2(tree, pos, step, spot, n, proof, folded) AS (
  SELECT c1.tree, c1.pos, 0, sub.r, sub.n, c1.proof, c1.folded FROM c1 JOIN sub USING (tree) WHERE c1.n = 1
  UNION ALL
  SELECT c.tree, c.pos, any_value(c.step) + 1, any_value(c.spot) // 8, (any_value(c.n) + 7) // 8,
         any_value(c.proof) || coalesce(string_agg(uv.h, '' ORDER BY uv.idx) FILTER (uv.idx <> c.spot), ''),
         sha256(string_agg(CASE WHEN uv.idx = c.spot THEN c.folded ELSE uv.h END, '' ORDER BY uv.idx))
  FROM c2 c JOIN uv ON uv.step = c.step AND uv.idx // 8 = c.spot // 8
  WHERE c.n > 1 GROUP BY c.tree, c.pos)
SELECT p.doc_id, p.leaf, sub.h AS subroot, (SELECT h FROM uv WHERE n = 1) AS root, sha256(c2.proof) AS proof_sha256,
       c2.folded AS folded_root, c2.folded = (SELECT h FROM uv WHERE n = 1) AS verified
FROM c2 JOIN p USING (tree, pos) JOIN sub USING (tree) WHERE c2.n = 1
"""

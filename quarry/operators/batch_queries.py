"""Many queries of any form in one job: a table of query strings, or query values.

Queries are taken in blocks of at most BLOCK_QUERIES. A block's queries are
parsed on the driver into leaves (term, phrase, prefix, fuzzy, range,
equality) and a tree of must / should / must-not nodes. Then, for the block:

1. Equal queries are one program, so a thousand queries for `the` cost one.
2. Every distinct leaf is matched once: one scan of the term table for the
   words of all term and phrase leaves and of the vocabulary terms that prefix
   and fuzzy leaves accept, one of the value table for all ranges and
   equalities. Their rows (leaf, doc_id, score) are written, and counted.
3. From the counts each program gets its cover: the cheapest leaves without
   one of which no document matches (for required clauses the rarest of them,
   for optional ones all). Only the cover's rows make candidates (program,
   doc_id); the other leaves, frequent words among them, are looked up by
   (leaf, doc_id).
4. A disjunction ranked to its top k needs less than all its leaves: as many
   of the weakest as cannot together reach a lower bound of the k-th score are
   looked up as well (exact MaxScore, on the leaves' own highest scores).
5. Each program is evaluated over its candidates' leaf rows, from the deepest
   nodes up: one aggregation a level, all within one exchange by (program,
   doc_id).

A program's hits are ranked, cut to k and only then given to its queries.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.predicates import (SCANNED_RANGES, _check_numeric, _searchable_text, equals_condition, fuzzy_vocabulary,
                                         prefix_terms, range_condition, value_ranges)
from quarry.operators.ranking import DEFAULT_LIMIT, top_k_per_query
from quarry.operators.scoring import bm25, idf
from quarry.query import Bool, Equals, Fuzzy, Nothing, Phrase, Prefix, Query, Range, Term
from quarry.querystring import parse
from quarry.schema import SearchError
from quarry.session import scratch_path

# Queries compiled on the driver at once: their words, leaves and nodes are
# the only tables that are broadcast.
BLOCK_QUERIES = 2_000
# Rows of the rarest leaves that are to yield a disjunction's first threshold,
# as a multiple of k.
SEED_FACTOR = 8
# Far wider than the 1e-9 to which scores are ranked.
PRUNE_MARGIN = 1e-6

MUST, SHOULD, NOT = 0, 1, 2


@dataclass
class _Program:
    """Leaves with their paths: ((role, parent node, must clauses of it), ...) from the root."""
    query: Query
    leaves: list[tuple[int, tuple]] = field(default_factory=list)


class _Block:
    """The distinct leaves and programs of a block of queries."""

    def __init__(self, queries: list[tuple[object, Query]]):
        self.leaf_ids: dict[Query, int] = {}
        self.programs: list[_Program] = []
        self.asked: list[tuple[object, int]] = []       # (query id, program)
        known: dict[Query, int] = {}
        for name, q in queries:
            if q not in known:
                known[q] = len(self.programs)
                self.programs.append(self._program(q))
            self.asked.append((name, known[q]))

    def _program(self, query: Query) -> _Program:
        out, nodes = _Program(query), [0]

        def walk(q: Query, path: tuple):
            if isinstance(q, Bool):
                nodes[0] += 1
                node = nodes[0]
                for role, clauses in ((MUST, q.must), (SHOULD, q.should), (NOT, q.must_not)):
                    for c in clauses:
                        walk(c, path + ((role, node, len(q.must)),))
            else:
                out.leaves.append((self.leaf_ids.setdefault(q, len(self.leaf_ids)), path))

        walk(query, ())
        return out

    def cover(self, query: Query, counts: dict[int, int]) -> set[int]:
        """Leaves of which every matching document has one."""
        if not isinstance(query, Bool):
            return {self.leaf_ids[query]}
        if query.must:
            return min((self.cover(q, counts) for q in query.must), key=lambda ls: sum(counts.get(i, 0) for i in ls))
        return set().union(*(self.cover(q, counts) for q in query.should))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"queries-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _text_leaves(index, leaves: dict[Query, int]) -> DataFrame | None:
    """(leaf, doc_id, score) of all text leaves, from one scan of the term table."""
    spark = index.spark
    words, expanded = [], []            # (leaf, field, term, place in the phrase)
    for q, i in leaves.items():
        if isinstance(q, Term) and _searchable_text(index, q.field):
            words.append((i, q.field, q.value, -1))
        elif isinstance(q, Phrase) and q.terms and _searchable_text(index, q.field):
            words += [(i, q.field, t, at) for at, t in enumerate(q.terms)]
        elif isinstance(q, Prefix) and _searchable_text(index, q.field, "prefix"):
            expanded.append(index.vocabulary(prefix_terms(index, q)).select(F.lit(i).alias("leaf"), "field", "term"))
        elif isinstance(q, Fuzzy) and _searchable_text(index, q.field, "fuzzy"):
            expanded.append(fuzzy_vocabulary(index, q).select(F.lit(i).alias("leaf"), "field", "term"))
    if not words and not expanded:
        return None
    asked = spark.createDataFrame(words, "leaf int, field string, term string, at int")
    phrases = asked.where("at >= 0")
    variants = _written(_union(expanded), "variants") if expanded else None
    wanted = asked.groupBy("field", "term").agg(F.bool_or(F.col("at") >= 0).alias("placed"))
    if variants is not None:
        wanted = (wanted.unionByName(variants.select("field", "term", F.lit(False).alias("placed")))
                        .groupBy("field", "term").agg(F.bool_or("placed").alias("placed")))
    # the scan: pushed to the words where the block names them all
    terms = index.terms
    if variants is None:
        named = reduce(lambda x, y: x | y, [
            (F.col("field") == f) & value_ranges("term", [w[2] for w in words if w[1] == f], SCANNED_RANGES) for f in sorted({w[1] for w in words})])
        terms = terms.where(named)
        wanted = F.broadcast(wanted)
    rows = _written(terms.join(wanted, ["field", "term"]).select(
        "field", "term", "doc_id", "tf", "dl", F.when(F.col("placed"), F.col("positions")).alias("positions")), "terms")
    out = []
    n_docs, avgdl = index.stat_columns()
    df = index.vocabulary(F.col("field").isin(sorted({w[1] for w in words})), only=asked.select("term")).select("field", "term", "df") if words else None
    if words:
        weighted = _written(asked.join(df, ["field", "term"]).withColumn("idf", idf(F.col("df"), n_docs)), "weights")
        one = F.broadcast(weighted.where("at < 0").select("leaf", "field", "term", "idf"))
        out.append(rows.join(one, ["field", "term"]).select("leaf", "doc_id", bm25(F.col("idf"), F.col("tf"), F.col("dl"), avgdl).alias("score")))
        if any(w[3] >= 0 for w in words):
            # a phrase's rarest word makes its candidates; the other words are
            # looked up for these, so a frequent word of many phrases is not
            # joined with all of them
            placed = weighted.where("at >= 0").withColumn("nth", F.row_number().over(Window.partitionBy("leaf").orderBy("df", "at")))
            placed = _written(placed, "phrases")
            starts = F.transform("positions", lambda p: p - F.col("at")).alias("starts")
            lead = _written(rows.join(F.broadcast(placed.where("nth = 1")), ["field", "term"]).select("leaf", "doc_id", "dl", starts), "leads")
            others = lead.select("leaf", "doc_id").join(F.broadcast(placed.where("nth > 1")), "leaf")
            each = lead.unionByName(others.join(rows, ["field", "term", "doc_id"]).select("leaf", "doc_id", "dl", starts))
            size = F.broadcast(phrases.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")))
            total = F.broadcast(placed.groupBy("leaf", "field").agg(F.sum("idf").alias("idf")))
            both = (each.groupBy("leaf", "doc_id").agg(F.any_value("dl").alias("dl"), F.collect_list("starts").alias("all"))
                        .join(size, "leaf").where(F.size("all") == F.col("size")))
            shared = F.aggregate(F.slice("all", 2, 1 << 30), F.get("all", F.lit(0)), lambda acc, x: F.array_intersect(acc, x))
            found = both.withColumn("pf", F.size(shared)).where("pf > 0").join(total, "leaf")
            out.append(found.select("leaf", "doc_id", bm25(F.col("idf"), F.col("pf"), F.col("dl"), avgdl).alias("score")))
    if variants is not None:
        out.append(variants.join(rows, ["field", "term"]).select("leaf", "doc_id").distinct().withColumn("score", F.lit(1.0)))
    return _union(out)


def _value_leaves(index, leaves: dict[Query, int]) -> DataFrame | None:
    """(leaf, doc_id, score) of all ranges and equalities, from one scan of the value table."""
    tests: list[tuple[Column, int]] = []
    for q, i in leaves.items():
        if isinstance(q, Range):
            cond = range_condition(index, q)
        elif isinstance(q, Equals):
            cond = equals_condition(index, q)
        else:
            continue
        if index.schema.field(q.field).indexed:
            tests.append((cond, i))
    if not tests:
        return None
    hit = F.filter(F.array(*[F.when(c, F.lit(i)) for c, i in tests]), lambda x: x.isNotNull())
    any_of = reduce(lambda x, y: x | y, [c for c, _ in tests])
    return index.values.where(any_of).select(F.explode(hit).alias("leaf"), "doc_id", F.lit(1.0).alias("score"))


def _matched(index, block: _Block) -> DataFrame:
    """(leaf, doc_id, score): every distinct leaf of the block, matched once."""
    for q in block.leaf_ids:
        if isinstance(q, (Range, Equals)):
            _check_numeric(index, q)
        elif not isinstance(q, (Term, Phrase, Prefix, Fuzzy, Nothing)):
            raise SearchError(f"Unknown query leaf {q!r}")
    parts = [p for p in (_text_leaves(index, block.leaf_ids), _value_leaves(index, block.leaf_ids)) if p is not None]
    if not parts:
        return index.spark.createDataFrame([], f"leaf int, doc_id {index.id_type}, score double")
    return _written(_union(parts), "leaves")


def _evaluated(rows: DataFrame, depth: int) -> DataFrame:
    """(program, doc_id, score) from the rows of leaves with their paths.

    `path` holds (role, node, need) from the root. A level's rows are grouped
    by their parent node; rows of shallower nodes wait, alone in a group."""
    rows = rows.repartition("program", "doc_id")
    for d in range(depth, 0, -1):
        here = F.size("path") == d
        last = F.get("path", F.lit(d - 1))
        rows = (rows.withColumn("parent", F.when(here, last["node"]).otherwise(-F.col("node")))
                    .withColumn("role", F.when(here, last["role"])).withColumn("need", F.when(here, last["need"]))
                    .groupBy("program", "doc_id", "parent")
                    .agg(F.first("need").alias("need"), F.count_if(F.col("role") == MUST).alias("must"),
                         F.count_if(F.col("role") == SHOULD).alias("should"), F.count_if(F.col("role") == NOT).alias("nots"),
                         F.first("path").alias("path"), F.first("node").alias("node"),
                         F.sum(F.when(F.coalesce("role", F.lit(MUST)) != NOT, F.col("score")).otherwise(0.0)).alias("score"))
                    .where("need is null or (nots = 0 and must = need and (need > 0 or should > 0))")
                    .select("program", "doc_id", F.when(F.col("need").isNull(), F.col("path")).otherwise(F.slice("path", 1, d - 1)).alias("path"),
                            F.when(F.col("need").isNull(), F.col("node")).otherwise(F.col("parent")).alias("node"), "score"))
    return rows.select("program", "doc_id", "score")


def _thresholds(index, block: _Block, matched: DataFrame, counts, tops, k: int) -> dict[int, set[int]]:
    """program -> leaves that need not make candidates, for the disjunctions of
    plain leaves: the weakest, whose highest scores together stay below the
    k-th best sum over the program's rarest leaves."""
    plain = {}
    for p, prog in enumerate(block.programs):
        q = prog.query
        if isinstance(q, Bool) and not q.must and not q.must_not and not any(isinstance(c, Bool) for c in q.should):
            plain[p] = [i for i, _ in prog.leaves]
    seeds = []
    for p, ids in plain.items():
        seen = 0
        for i in sorted(ids, key=lambda i: counts.get(i, 0)):
            if seen >= SEED_FACTOR * k:
                break
            seeds.append((p, i))
            seen += counts.get(i, 0)
    if not seeds:
        return {}
    pairs = F.broadcast(index.spark.createDataFrame(seeds, "program int, leaf int"))
    sums = matched.join(pairs, "leaf").groupBy("program", "doc_id").agg(F.sum("score").alias("score"))
    least = (top_k_per_query(sums, k, "program", spread=False).groupBy("program")
             .agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least")).collect())
    weak: dict[int, set[int]] = {}
    for r in least:
        if r["least"] is None:
            continue
        total, mine = 0.0, {i for p, i in seeds if p == r["program"]}
        for i in sorted(plain[r["program"]], key=lambda i: tops.get(i, 0.0)):
            total += tops.get(i, 0.0)
            if total >= r["least"] - PRUNE_MARGIN:
                break
            if i not in mine:
                weak.setdefault(r["program"], set()).add(i)
    return weak


def _block_hits(index, block: _Block, k: int | None) -> DataFrame:
    """(program, doc_id, score): all hits of every program, or with k at least
    those that can be among its k best."""
    spark = index.spark
    matched = _matched(index, block)
    stats = matched.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("top")).collect()
    counts, tops = {r["leaf"]: r["n"] for r in stats}, {r["leaf"]: r["top"] for r in stats}
    weak = _thresholds(index, block, matched, counts, tops, k) if k else {}
    nodes = []
    for p, prog in enumerate(block.programs):
        makes = block.cover(prog.query, counts) - weak.get(p, set())
        for at, (leaf, path) in enumerate(prog.leaves):
            nodes.append((p, leaf, at, leaf in makes, [{"role": r, "node": n, "need": m} for r, n, m in path]))
    # leaves are numbered above any node, so that a waiting row is alone in its group
    table = F.broadcast(_written(spark.createDataFrame(
        [(p, leaf, at + 1_000_000, makes, path) for p, leaf, at, makes, path in nodes],
        "program int, leaf int, node int, makes boolean, path array<struct<role: int, node: int, need: int>>"), "nodes"))
    own = matched.join(table.where("makes"), "leaf").select("program", "doc_id", "path", "node", "score")
    rest = table.where("not makes")
    rows = own
    if not all(n[3] for n in nodes):
        own = _written(own, "candidates")
        asked = own.select("program", "doc_id").distinct().join(rest, "program")
        rows = own.unionByName(asked.join(matched, ["leaf", "doc_id"]).select("program", "doc_id", "path", "node", "score"))
    return _evaluated(rows, max((len(n[4]) for n in nodes), default=0))


def _blocks(queries):
    block = []
    for q in queries:
        block.append(q)
        if len(block) == BLOCK_QUERIES:
            yield block
            block = []
    if block:
        yield block


def _compiled(index, queries: DataFrame, default_fields: list[str], text_col: str, key: str):
    """(id, query value) of a table of query strings. A string that does not
    parse is an error that names its row."""
    if not default_fields:
        raise SearchError("At least one default field must be provided")
    for f in default_fields:
        index.schema.field(f)
    for r in queries.select(F.col(key).alias("id"), F.col(text_col).alias("text")).toLocalIterator():
        try:
            yield r["id"], parse(index.schema, default_fields, r["text"] or "")
        except SearchError as e:
            raise SearchError(f"Query {r['id']!r}: {e}") from None


def _answers(index, compiled, id_type: str, k: int | None) -> DataFrame:
    spark, out = index.spark, None
    for part in _blocks(compiled):
        block = _Block(part)
        hits = _block_hits(index, block, k)
        if k:
            hits = top_k_per_query(hits, k, "program", spread=False)
        asked = _written(spark.createDataFrame(block.asked, f"query_id {id_type}, program int"), "asked")
        rows = hits.join(asked, "program").drop("program")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = spark.createDataFrame([], f"query_id {id_type}, doc_id {index.id_type}, score double" + (", rank int" if k else ""))
    return out.select("query_id", *(["rank"] if k else []), "doc_id", "score")


def batch_query_strings(index, queries: DataFrame, default_fields: list[str], k: int | None = DEFAULT_LIMIT,
                        text_col: str = "text", key: str = "query_id") -> DataFrame:
    """Top k (None: all) hits of every query string: (query_id, rank, doc_id, score)."""
    return _answers(index, _compiled(index, queries, default_fields, text_col, key), queries.schema[key].dataType.simpleString(), k)


def batch_queries(index, queries: dict[int, Query], k: int | None = DEFAULT_LIMIT) -> DataFrame:
    """The same for query values by a whole number, prefix and fuzzy leaves among them."""
    return _answers(index, iter(queries.items()), "long", k)

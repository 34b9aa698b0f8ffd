"""Bounded top-k: the best k hits of a disjunction of words without reading
all their rows.

A written index keeps, for each frequent term and each block of consecutive
ids, the largest share of idf * (k1 + 1) that the term adds to a document
there (`tops`). A rare term's rows are few and give its blocks' tops as they
are. The sum over a query's words is an upper bound of any score in a block.

1. The blocks with the highest bounds (FIRST_BLOCKS) are scored exactly; the
   k-th best score there is a lower bound of the final one.
2. Of the others, only blocks whose bound reaches it are read and scored.

Blocks ascend with the ids and the term table is sorted on (term, id), so what
is read of a term are the pages of these blocks. Nothing is estimated: a block
left out holds no document of the top k, ties included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.analysis import BLOCK_COL, frequent_words
from quarry.operators.predicates import _pairs_filter, term_rows, value_ranges
from quarry.operators.ranking import top_k
from quarry.operators.scoring import K1, bm25_share, idf
from quarry.query import Bool, Query, Term
from quarry.session import scratch_path
from quarry.sources.corpus import COMMIT_COL

# Rows of its words from which a query is worth two passes.
BOUNDED_FROM = 1_000_000
FIRST_BLOCKS = 8
# Blocks that are brought to the driver to make pushed ranges of; with more, all rows are read.
PUSHED_BLOCKS = 10_000
# Far wider than the 1e-9 to which scores are ranked.
MARGIN = 1e-6


def words_of(query: Query) -> list[Term] | None:
    """The words of a disjunction of words; None for any other query."""
    if isinstance(query, Term):
        return [query]
    if isinstance(query, Bool) and not query.must and not query.must_not:
        parts = [words_of(q) for q in query.should]
        if all(p is not None for p in parts):
            return [t for p in parts for t in p]
    return None


def _by_commit(blocks: list) -> list[tuple]:
    return [(c, [b for k, b in blocks if k == c]) for c in sorted({b[0] for b in blocks})]


def _of_blocks(blocks: list) -> Column:
    """Rows of the blocks (commit, block) and of no others."""
    out = F.lit(False)
    for c, own in _by_commit(blocks):
        out = out | ((F.col(COMMIT_COL) == c) & F.col(BLOCK_COL).isin(own))
    return out


def _in_blocks(blocks: list) -> Column:
    """Rows of the blocks (commit, block), by ranges that parquet skips pages by;
    where these are few for the blocks, of blocks between them as well."""
    out = F.lit(False)
    for c, own in _by_commit(blocks):
        out = out | ((F.col(COMMIT_COL) == c) & value_ranges(BLOCK_COL, own))
    return out


def bounded_hits(index, query: Query, k: int) -> DataFrame | None:
    """(doc_id, score) of all documents that can be among the query's k best;
    None where the query, the index or the number of rows is not for it."""
    words = words_of(query)
    if not words or index.tops is None or not all(index.schema.require_text(w.field).indexed for w in words):
        return None
    times: dict[tuple[str, str], int] = {}
    for w in words:
        times[w.field, w.value] = times.get((w.field, w.value), 0) + 1
    cond = _pairs_filter(times)
    dfs = {(r["field"], r["term"]): r["df"] for r in index.vocabulary(cond).select("field", "term", "df").collect()}
    if sum(dfs.values()) < BOUNDED_FROM:
        return None
    spark, values = index.spark, index.stat_values()
    n_docs, avgdl = index.stat_columns()
    own = spark.createDataFrame([(f, t, d, n) for (f, t), n in times.items() if (d := dfs.get((f, t)))], "field string, term string, df long, times int")
    most = F.col("times") * idf(F.col("df"), n_docs) * (K1 + 1.0)
    weights = F.broadcast(own.select("field", "term", most.alias("most")))       # a row a word of the query
    growth = {f: index.mean_growth(f) for f in {f for f, _ in times}}
    grown = F.create_map(*[x for f, g in sorted(growth.items()) for x in (F.lit(f), F.lit(float(g)))])
    kept = index.tops.where(cond).select("field", "term", COMMIT_COL, BLOCK_COL, F.least(
        F.col("top") * F.element_at(grown, F.col("field")), F.lit(1.0)).alias("top"))
    # a word that a commit has too seldom for `tops` gives its rows themselves
    own_vocab = index._pin(index._vocab).where(cond).join(F.broadcast(index._pin(index._stats)), [COMMIT_COL, "field"])
    own_vocab = own_vocab.where(~frequent_words(own_vocab, F.col("n_docs"))).select("field", "term", COMMIT_COL)
    if not own_vocab.isEmpty():
        seldom = index.terms.where(cond).join(F.broadcast(own_vocab), ["field", "term", COMMIT_COL], "left_semi")
        share = bm25_share(F.col("tf"), F.col("dl"), avgdl)
        kept = kept.unionByName(seldom.groupBy("field", "term", COMMIT_COL, BLOCK_COL).agg(F.max(share).alias("top")))
    path = scratch_path(spark, "bounds")
    bound = kept.join(weights, ["field", "term"]).groupBy(COMMIT_COL, BLOCK_COL).agg(F.sum(F.col("most") * F.col("top")).alias("bound"))
    bound.write.parquet(path)
    bound = spark.read.schema(bound.schema).parquet(path)

    def scored(where) -> DataFrame:
        rows = term_rows(index, list(enumerate(words)), where)
        return rows.groupBy("doc_id").agg(F.sum("score").alias("score"))

    first = [(r[0], r[1]) for r in bound.orderBy(F.desc("bound"), COMMIT_COL, BLOCK_COL).limit(max(FIRST_BLOCKS, k // 8)).collect()]
    best = top_k(scored(_in_blocks(first) & _of_blocks(first)), k).collect()
    least = min(r["score"] for r in best) - MARGIN if len(best) == k else 0.0
    open_ = bound.where(F.col("bound") >= least)
    blocks = [(r[0], r[1]) for r in open_.select(COMMIT_COL, BLOCK_COL).limit(PUSHED_BLOCKS + 1).collect()]
    if len(blocks) > PUSHED_BLOCKS:
        return scored(None)
    # of the first blocks the k best are known: where ranges of the others span them, they are not read again
    done = set(first)
    hits = scored(_in_blocks([b for b in blocks if b not in done]) & ~_of_blocks(first))
    return hits.unionByName(spark.createDataFrame([(r["doc_id"], r["score"]) for r in best], hits.schema))


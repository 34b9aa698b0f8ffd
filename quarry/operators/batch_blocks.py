"""The best documents of many queries, a block of documents at a time.

A row a query and document that share a word is never dealt out: the postings
of the queries' words are, once, by blocks of documents (a hash of the id), and
a task scores all queries of a chunk against a block in arrays. What leaves it
are the block's k best documents of each query.

In a block the pruning is the same as over all documents (MaxScore): a query's
essential words give the candidates, the others, by descending bound, are looked
up for those candidates only that can still reach the k-th score known by then:
theta, or the k-th best partial score in the block, if that is higher.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.chunks import _order, _starts
from quarry.operators.scoring import bm25_share

# Postings of a block and query words of a chunk, about.
BLOCK_ROWS = 1 << 19
QUERY_WORDS = 1 << 16
# Documents within this margin of the k-th score stay in, far more than the 1e-9
# to which scores are ranked.
PRUNE_MARGIN = 1e-6


def _ranked(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct values in order, and each row's place among them."""
    encoded = column.combine_chunks().dictionary_encode(null_encoding="encode")
    order = pc.sort_indices(encoded.dictionary, null_placement="at_start").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return encoded.dictionary.take(pa.array(order)), place[encoded.indices.to_numpy()]


def _kth(score: np.ndarray, k: int, least: float) -> float:
    return max(least, float(np.partition(score, -k)[-k])) if len(score) >= k else least


def _best(lists: list[tuple[np.ndarray, np.ndarray]], n_essential: int, most: np.ndarray, theta: float, n_docs: int, k: int):
    """(documents, scores) of a query that can be among its k best: `lists` has each word's documents and
    contributions, essential words first, `most` what each can add."""
    score, reached = np.zeros(n_docs), np.zeros(n_docs, bool)
    for docs, added in lists[:n_essential]:
        score[docs] += added
        reached[docs] = True
    found = np.flatnonzero(reached)
    score = score[found]
    left = np.append(np.cumsum(most[n_essential:][::-1])[::-1], 0.0)
    for i, rest in enumerate(left):
        theta = _kth(score, k, theta)
        can = score + rest >= theta - PRUNE_MARGIN
        found, score = found[can], score[can]
        if not len(found) or i == len(left) - 1:
            break
        docs, added = lists[n_essential + i]
        at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
        score = score + np.where(docs[at] == found, added[at], 0.0)
    # of documents of the very same score (copies) the k smallest ids are enough
    order = np.lexsort((found, -score))
    found, score = found[order], score[order]
    if len(found) > k:
        runs = _starts(score[1:] != score[:-1])
        nth = np.arange(len(score)) - np.repeat(runs, np.diff(np.append(runs, len(score))))
        found, score = found[nth < k], score[nth < k]
    return found, score


def _block(k: int, mean: float) -> Callable:
    """The task: a block's postings (term, doc_id, tf, dl) and a chunk's query words
    (query_id, term, ub, theta, essential) to (query_id, doc_id, score)."""

    def run(rows: pa.Table, words: pa.Table) -> pa.Table:
        nothing = pa.table({"query_id": words["query_id"].slice(0, 0), "doc_id": rows["doc_id"].slice(0, 0), "score": pa.array([], pa.float64())})
        if not rows.num_rows:
            return nothing
        terms, term = _ranked(rows["term"])
        ids, doc = _ranked(rows["doc_id"])
        share = bm25_share(rows["tf"].to_numpy().astype(float), rows["dl"].to_numpy().astype(float), mean)
        key = term * len(ids) + doc
        order = _order(key)
        key, share = key[order], share[order]
        once = _starts(key[1:] != key[:-1])
        key, share = key[once], np.add.reduceat(share, once)
        doc, ends = key % len(ids), np.searchsorted(key, np.arange(len(terms) + 1) * len(ids))
        # a word that the block does not hold adds nothing here
        at = pc.index_in(words["term"], value_set=terms)
        words = words.append_column("at", at).filter(pc.is_valid(at))
        if not words.num_rows:
            return nothing
        queries, query = _ranked(words["query_id"])
        at, most, theta = (words[c].to_numpy() for c in ("at", "ub", "theta"))
        essential = words["essential"].to_numpy()
        order = np.lexsort((at, -most, ~essential, query))
        query, at, most, theta, essential = (x[order] for x in (query, at, most, theta, essential))
        starts, out = _starts(query[1:] != query[:-1]).tolist(), []
        for lo, hi in zip(starts, [*starts[1:], len(query)]):
            places = [(ends[a], ends[a + 1]) for a in at[lo:hi]]
            lists = [(doc[x:y], m * share[x:y]) for (x, y), m in zip(places, most[lo:hi])]
            found, score = _best(lists, int(essential[lo:hi].sum()), most[lo:hi], theta[lo], len(ids), k)
            out.append((np.full(len(found), query[lo]), found, score))
        query, found, score = (np.concatenate(x) for x in zip(*out))
        return pa.table({"query_id": queries.take(pa.array(query)), "doc_id": ids.take(pa.array(found)), "score": pa.array(score)})

    return run


def block_hits(postings: DataFrame, words: DataFrame, n_postings: int, n_words: int, mean: float, k: int) -> DataFrame:
    """(query_id, doc_id, score) of the documents that can be among each query's k best, from the
    postings (term, doc_id, tf, dl) of the query words (query_id, term, ub, theta, essential): `ub`
    is the most a word adds, `theta` a lower bound of the query's k-th score."""
    blocks, chunks = max(1, -(-n_postings // BLOCK_ROWS)), max(1, -(-n_words // QUERY_WORDS))
    words = words.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)))
    if chunks == 1:
        postings = postings.withColumn("chunk", F.lit(0).cast("long"))
    else:       # a chunk gets the postings of its words
        postings = postings.join(words.select("chunk", "term").distinct(), "term")
    rows = postings.select((F.col("chunk") * blocks + F.pmod(F.xxhash64("doc_id"), F.lit(blocks))).alias("part"), "term", "doc_id", "tf", "dl")
    first = F.col("chunk") * blocks
    words = words.select(F.explode(F.sequence(first, first + (blocks - 1))).alias("part"), "query_id", "term", "ub", "theta", "essential")
    schema = T.StructType([T.StructField("query_id", words.schema["query_id"].dataType), T.StructField("doc_id", rows.schema["doc_id"].dataType),
                           T.StructField("score", T.DoubleType())])
    return rows.groupBy("part").cogroup(words.groupBy("part")).applyInArrow(_block(k, mean), schema)

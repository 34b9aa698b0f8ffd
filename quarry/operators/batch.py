"""Many queries in one job (G1) and column-wise typo correction (G2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.distance import deletion_keys, edit_distance
from quarry.functions.text import DEFAULT, Analyzer, tokens
from quarry.operators.batch_blocks import PRUNE_MARGIN, block_hits
from quarry.operators.ranking import DEFAULT_LIMIT, top_k_per_query
from quarry.operators.scoring import K1, bm25, idf
from quarry.schema import SearchError
from quarry.session import scratch_path

# The seed takes a query's rarest words until their document frequencies sum
# to SEED_FACTOR * k, so that (despite words sharing documents) the seed
# usually yields k documents and a useful threshold.
SEED_FACTOR = 8


def query_terms(queries: DataFrame, text_col: str = "text", key: str = "query_id", analyzer: Analyzer = DEFAULT) -> DataFrame:
    """(query_id, term, qtf): a query's whole text analysed like documents.
    A word written twice counts twice, as two OR clauses would."""
    return (queries.select(F.col(key).alias("query_id"), F.explode(tokens(text_col, analyzer)).alias("term")).where("term != ''")
                   .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf")))


def _shared(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"batch-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batch_hits(index, qt: DataFrame, field: str, k: int = DEFAULT_LIMIT) -> DataFrame:
    """(query_id, doc_id, score) of the bag-of-words OR query of each query's
    words (query_id, term, qtf): the documents that can reach a query's top k
    (exact MaxScore pruning), about k of each query and block of documents.

    Joining query words to the term table on `term` would emit every
    (query, document) pair that shares a frequent word such as `the`. So:

    1. seed: each query's rarest words, until their document frequencies
       add up to SEED_FACTOR * k, are joined to the term table;
    2. their summed contributions are lower bounds of exact scores, so the
       k-th best of them, theta, is a lower bound of the final k-th score;
    3. a word's contribution is below ub = qtf * idf * (k1 + 1). Taking the
       words by ascending ub, the longest run whose ub sum stays below theta
       (less a margin wider than the ranking precision) is non-essential: a
       document holding only those words scores below theta and cannot
       enter the top k. Seed words are always essential. Only essential
       words give candidates;
    4. the rows of the query words are dealt once, by blocks of documents,
       and each block scores its candidates exactly (`batch_blocks`): what is
       dealt grows with the postings, not with the pairs of query and document.

    Every window is per query (bounded by its word count); the query-side
    tables grow with the query table and are never broadcast by hint.
    """
    index.schema.require_text(field)
    n_docs, mean = index.stat_values().get(field, (0, 0.0))
    n_docs, avgdl = F.lit(n_docs).cast("long"), F.lit(float(mean))

    # the query words are looked up once; only their vocabulary rows are
    # summed over commits
    voc = index.vocabulary(F.col("field") == field, only=qt).select("term", "df")
    words = _shared(qt.join(voc, "term").select(
        "query_id", "term", "qtf", "df", idf(F.col("df"), n_docs).alias("idf")), "weighted")
    # the one scan of the term table: rows of the query words
    tt = _shared(index.terms.where(F.col("field") == field).select("term", "doc_id", "tf", "dl")
                     .join(words.select("term"), "term", "left_semi"), "terms")

    def scored(rows: DataFrame) -> DataFrame:
        contribution = F.col("qtf") * bm25(F.col("idf"), F.col("tf"), F.col("dl"), avgdl)
        return rows.groupBy("query_id", "doc_id").agg(F.sum(contribution).alias("score"))

    cols = ("query_id", "term", "qtf", "idf")
    rare = Window.partitionBy("query_id").orderBy("df", "term")
    qv = (words.withColumn("cum_df", F.sum("df").over(
                rare.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
               .withColumn("seed", F.col("cum_df") - F.col("df") < SEED_FACTOR * k))
    # partial scores over the seed words are lower bounds of exact scores, so
    # their k-th best is a lower bound of the query's final k-th score
    partial = scored(qv.where("seed").select(*cols).join(tt, "term"))
    kth = (top_k_per_query(partial, k, spread=False)
           .groupBy("query_id")
           .agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(0.0)).alias("theta")))
    low = Window.partitionBy("query_id").orderBy("ub", "term") \
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    theta = F.coalesce(F.col("theta"), F.lit(0.0))
    split = _shared(qv.withColumn("ub", F.col("qtf") * F.col("idf") * (K1 + 1.0))
                     .join(kth, "query_id", "left")
                     .select("query_id", "term", "ub", theta.alias("theta"),
                             (F.col("seed") | (F.sum("ub").over(low) >= theta - PRUNE_MARGIN)).alias("essential")), "split")
    size = (words.groupBy("term").agg(F.any_value("df").alias("df"), F.count(F.lit(1)).alias("n"))
                 .agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first())
    return block_hits(tt, split, *size, float(mean), k)


def batch_search(index, queries: DataFrame, field: str, k: int = DEFAULT_LIMIT,
                 text_col: str = "text", key: str = "query_id") -> DataFrame:
    """Top k documents for every query row: (query_id, rank, doc_id, score).

    Queries of the same words are one: it is scored and cut to k, then given
    to each of them, so a thousand queries for a frequent word cost as one."""
    qt = _shared(query_terms(queries, text_col, key, index.schema.require_text(field).analyzer), "words")
    bags = qt.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", "qtf"))).alias("bag"))
    first = bags.groupBy("bag").agg(F.min("query_id").alias("first"))
    members = _shared(bags.join(first, "bag").select("query_id", "first"), "members")
    one = members.where(F.col("query_id") == F.col("first")).select("query_id")
    hits = batch_hits(index, qt.join(one, "query_id", "left_semi"), field, k)
    top = top_k_per_query(hits, k, spread=False).withColumnRenamed("query_id", "first")
    return members.join(top, "first").select("query_id", "rank", "doc_id", "score")


def batch_fuzzy(index, words: DataFrame, field: str, distance: int = 1,
                transposition: bool = True, word_col: str = "word") -> DataFrame:
    """(word, term, distance) for every vocabulary term within `distance` of
    each word. Candidates meet on shared deletion keys (an equi-join, no
    all-pairs), then the exact distance is computed on candidates only."""
    if not 0 <= distance <= 2:
        raise SearchError("Distance must be between 0 and 2")
    index.schema.require_text(field)
    w = words.select(F.col(word_col).alias("word")).distinct()
    v = index.vocabulary(F.col("field") == field).select("term")
    # The join key is (deletion key, term length): a word asks for every term
    # length within `distance` of its own. Short keys such as "" are shared
    # by many short strings; adding the length splits those groups, and the
    # length window is enforced by the equi-join itself.
    wk = w.select("word", F.explode(deletion_keys("word", distance)).alias("key"),
                  F.explode(F.sequence(F.greatest(F.char_length("word") - distance, F.lit(1)),
                                       F.char_length("word") + distance)).alias("tlen"))
    vk = v.select("term", F.explode(deletion_keys("term", distance)).alias("key"),
                  F.char_length("term").alias("tlen"))
    # the codegen'd bounded Levenshtein runs straight after the join, so only
    # near pairs are shuffled to drop repeats; a swap is at most two plain
    # edits, and plain edits of at most one cannot be bettered by a swap
    bound = 2 * distance if transposition else distance
    plain = F.levenshtein("word", "term", bound)
    cand = (wk.join(vk, ["key", "tlen"]).select("word", "term", plain.alias("plain"))
              .where("plain >= 0").distinct())
    d = F.col("plain")
    if transposition:
        d = F.when(d <= 1, d).otherwise(edit_distance(F.col("word"), F.col("term"), True))
    return cand.select("word", "term", d.alias("distance")).where(F.col("distance") <= distance)

"""Boolean composition of leaves as joins on the document.

Optional clauses are one union and one sum per document. Required clauses
are joined (text first, then numeric conditions, whose rows the join can
stream past a small set of hits), excluded ones anti-joined, so a wide range
or a frequent excluded word is not grouped with everything else. Groups and
joins are per document: no group is larger than the number of leaves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.predicates import leaf_rows
from quarry.query import Bool, Equals, Fuzzy, Phrase, Prefix, Query, Range, Term


def _optional(index, clauses) -> DataFrame:
    """(doc_id, score): documents that match any clause, scores summed."""
    rows = []
    text = [q for q in clauses if isinstance(q, (Term, Phrase))]
    if text:        # a row a leaf and document at most
        rows.append(leaf_rows(index, list(enumerate(text))).select("doc_id", "score"))
    rows += [evaluate(index, q) for q in clauses if not isinstance(q, (Term, Phrase))]
    if len(clauses) == 1:
        return rows[0]
    return reduce(DataFrame.unionByName, rows).groupBy("doc_id").agg(F.sum("score").alias("score"))


def evaluate(index, query: Query) -> DataFrame:
    """All documents the query matches: (doc_id, score). Uncapped."""
    if not isinstance(query, Bool):
        rows = leaf_rows(index, [(0, query)])
        if isinstance(query, (Prefix, Fuzzy)):
            # several matched terms per document: one row per document
            return rows.groupBy("doc_id").agg(F.max("score").alias("score"))
        return rows.select("doc_id", "score")
    if query.must:
        order = sorted(query.must, key=lambda q: isinstance(q, (Range, Equals)))
        out = evaluate(index, order[0])
        for q in order[1:]:
            if isinstance(q, (Range, Equals)):
                # a constant score: a filter on the document
                out = out.join(evaluate(index, q).select("doc_id"), "doc_id", "left_semi") \
                         .withColumn("score", F.col("score") + 1.0)
            else:
                more = evaluate(index, q).withColumnRenamed("score", "_more")
                out = out.join(more, "doc_id").select("doc_id", (F.col("score") + F.col("_more")).alias("score"))
        if query.should:
            more = _optional(index, query.should).withColumnRenamed("score", "_more")
            out = out.join(more, "doc_id", "left").select(
                "doc_id", (F.col("score") + F.coalesce("_more", F.lit(0.0))).alias("score"))
    else:
        out = _optional(index, query.should)
    for q in query.must_not:
        out = out.join(evaluate(index, q).select("doc_id"), "doc_id", "left_anti")
    return out

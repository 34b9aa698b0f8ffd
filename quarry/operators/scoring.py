"""BM25 relevance as column arithmetic (Robertson & Zaragoza 2009)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# BM25 parameters.
K1 = 1.2
B = 0.75


def idf(df: Column, n_docs: Column) -> Column:
    """ln(1 + (N - df + 0.5) / (df + 0.5)); always positive."""
    return F.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))


def bm25(idf_: Column, tf: Column, dl: Column, avgdl: Column) -> Column:
    norm = K1 * (1.0 - B + B * dl / avgdl)
    return idf_ * (K1 + 1.0) * tf / (tf + norm)


def bm25_share(tf: Column, dl: Column, avgdl: Column) -> Column:
    """A contribution as a share of the most a term can add, idf * (k1 + 1)."""
    return tf / (tf + K1 * (1.0 - B + B * dl / avgdl))

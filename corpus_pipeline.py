"""A cleaning pipeline over `documents`, from raw rows to token ids.

Every stage is a function (spark, docs, sf_dir) -> DataFrame; its rows are
written as Parquet and read again as the next stage's `docs`. All but the
last return the columns of `documents`.

Every stage takes rows with nulls in any column, empty and very long texts,
repeated ids and rows, further columns of any name (which it carries along)
and an empty table, which gives no rows. Of rows with the same id and text the
near-duplicate stage keeps one; rows without an id stay there; a null text is
scored as an empty one, links with nothing, stays null where it is cut, and has
no tokens. Ties go to the smaller id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import minmax_dedup, poisson_mix, quality_gbt, sentencepiece_bpe, suffix_dedup
from quarry.llm.common import apart, table, written
from quarry.llm.queries import PIECE_MODEL

# Near-duplicates here: five-word shingles, Jaccard similarity of 0.8 or more.
NEAR = {"k": 5, "num": 80, "den": 100}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's threshold."""
    return quality_gbt.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return minmax_dedup.deduplicated(docs, **NEAR)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that occur elsewhere too;
    n_chars counts what is left."""
    cut = suffix_dedup.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources replicated to their tempered weights, shuffled as a whole."""
    own, back = apart(docs, "rate", "copy", "mix_key")
    return poisson_mix.mix(own).select(*own.columns).withColumnsRenamed(back)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and as `text` what they decode to."""
    return sentencepiece_bpe.encode(docs, PIECE_MODEL, decoded_col="text")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("repeat_dedup", repeat_dedup), ("mix", mix),
          ("tokens", tokens)]

# Learnt trees, components and merge rounds are not SQL: tests compare the
# stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

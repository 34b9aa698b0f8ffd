"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from quarry.llm import (langid, license_diagonals, merkle, minmax_dedup, ngram_ratio, poisson_mix, projection_dedup, quality_gbt, ranked_search,
                        secret_scan, sentencepiece_bpe, suffix_dedup, url_cascade)
from quarry.llm.common import table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_projection_dedup(spark, sf_dir):
    return projection_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_url_cascade(spark, sf_dir):
    return url_cascade.verdicts(table(spark, sf_dir, "pages"))


def op3_ngram_ratio(spark, sf_dir):
    return ngram_ratio.query(spark, sf_dir)


def op4_license_diagonals(spark, sf_dir):
    return license_diagonals.query(spark, sf_dir)


def op5_minmax_near_dedup(spark, sf_dir):
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=3, num=85, den=100)


def op6_poisson_mix(spark, sf_dir):
    mixed = poisson_mix.mix(table(spark, sf_dir, "documents"))
    return mixed.withColumn("rate", F.round("rate", 6))


def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.predictions(docs, langid.train(docs, PIECE_MODEL))


def op8_quality_gbt(spark, sf_dir):
    return quality_gbt.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sentencepiece(spark, sf_dir):
    return sentencepiece_bpe.digests(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op10_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark, sf_dir):
    return merkle.proofs(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark, sf_dir):
    return ranked_search.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_projection_dedup, op2_url_cascade, op3_ngram_ratio, op4_license_diagonals, op5_minmax_near_dedup, op6_poisson_mix, op7_language_id, op8_quality_gbt, op9_sentencepiece,
                                   op10_suffix_dedup, op11_merkle_manifest, op12_ranked_search, op13_secret_scan)}
ORACLES: dict[str, str] = {"op2_url_cascade": url_cascade.ORACLE, "op6_poisson_mix": poisson_mix.ORACLE,
                           "op11_merkle_manifest": merkle.ORACLE, "op12_ranked_search": ranked_search.ORACLE,
                           "op13_secret_scan": secret_scan.ORACLE}

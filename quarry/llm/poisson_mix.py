"""Mixing sources to target weights by Poisson replication (operator 6).

Each document occurs as often as a Poisson variable of its source's rate
says: rate = target share of the source x wanted rows / rows of the source.
The variable comes from the inverse of the distribution at a number in
[0, 1) hashed from seed and id, so a run repeats itself, and no document's
count depends on another's. Every document is exploded by its count, and
the copies are sorted by a hash over the whole table, which spreads each
source evenly.

The table of rates has one row a source. A null source is a source of its
own; rows that repeat an id get the same count; a null id counts as an id of
its own. A source without a target weight has rate 0. Columns of the
documents stay, whatever their names, but for ones named as the added ones
(`rate`, `copy`, `mix_key`), which are replaced. Ties of the sort key are copies
of rows of one id. Null, empty and very long texts are rows like others; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import apart, fresh, written

SEED = 17
TEMPERATURE = 2.0      # default target weight of a source: its rows to the power 1 / TEMPERATURE


def _name(c: str) -> Column:
    """A source as text, with the null source apart from all others."""
    return F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(c).cast("string")))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 13 hexadecimal digits of an MD5 sum."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / float(1 << 52)


def tempered(docs: DataFrame, source_col: str = "source", temperature: float = TEMPERATURE) -> DataFrame:
    """(name, rows, weight) of each source: weight = rows ** (1 / temperature)."""
    return (docs.groupBy(_name(source_col).alias("name")).agg(F.count(F.lit(1)).alias("rows"))
                .withColumn("weight", F.pow(F.col("rows"), F.lit(1.0 / temperature))))


def rates(sources: DataFrame, wanted: float | None = None) -> DataFrame:
    """(name, rate, cdf): cdf[k] is the chance of at most k copies, as far as
    it differs from 1 in 12 digits. `wanted` rows are expected in all (as
    many as there are by default)."""
    total = sources.agg(F.sum("rows").alias("rows"), F.sum("weight").alias("weight"))
    all_rows = F.lit(float(wanted)) if wanted is not None else total.select("rows").scalar().cast("double")
    rate = (F.col("weight") / total.select("weight").scalar()) * all_rows / F.col("rows")
    rated = sources.select("name", rate.alias("rate"))
    # log of k! by running sums of logs; the last k is far in the tail
    last = F.ceil(F.col("rate") + 10 * F.sqrt("rate") + 20).cast("int")
    k = F.sequence(F.lit(0), last)
    log_factorial = F.aggregate(
        k, F.array().cast("array<double>"),
        lambda acc, i: F.concat(acc, F.array(F.when(i == 0, F.lit(0.0)).otherwise(
            F.element_at(acc, -1) + F.ln(i.cast("double"))))))
    return (rated.withColumn("lf", log_factorial)
            .withColumn("pmf", F.transform("lf", lambda f, i: F.exp(
                i * F.ln("rate") - F.col("rate") - f)))
            .withColumn("cdf", F.aggregate(
                "pmf", F.array().cast("array<double>"),
                lambda acc, p: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + p))))
            .select("name", "rate", F.transform("cdf", lambda c: F.round(c, 12)).alias("cdf")))


def mix(docs: DataFrame, weights: DataFrame | None = None, wanted: float | None = None,
        id_col: str = "doc_id", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """The documents, each as often as its count says (0 times or more), with
    its `rate`, the number of the `copy` (from 0) and `mix_key`, in the
    order of `mix_key` over the whole table. `weights`: (source, weight);
    tempered weights by default."""
    src, back = apart(fresh(docs, "rate", "copy", "mix_key"), "name", "cdf", "_name", "_n")
    id_col, source_col = ({v: k for k, v in back.items()}.get(c, c) for c in (id_col, source_col))
    sources = tempered(src, source_col)
    if weights is not None:
        given = weights.select(_name(weights.columns[0]).alias("name"),
                               F.col(weights.columns[1]).cast("double").alias("weight"))
        sources = sources.drop("weight").join(given, "name", "left").fillna(0.0, ["weight"])
    # written, so that the planner knows its size: broadcast if that is below
    # the session's threshold, and no shuffle of the documents by source
    table = written(rates(sources.where("weight > 0"), wanted), "rates")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    drawn = _uniform(F.lit(str(seed)), key)
    names = [F.col(f"`{c}`") for c in src.columns]
    counted = (src.withColumn("_name", _name(source_col))
                  .join(table, F.col("_name") == F.col("name"))
                  .withColumn("_n", F.size(F.filter("cdf", lambda c: c <= drawn)))
                  .where("_n > 0"))
    copies = counted.select(*names, "rate", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("copy"))
    return (copies.withColumn("mix_key", F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("order"), key,
                                                           F.col("copy").cast("string"))))
                  .orderBy("mix_key").withColumnsRenamed(back))


# DuckDB SQL for mix() with the default weights over `documents`.
ORACLE = """
WITH sources AS (
  SELECT CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS name, count(*) AS n,
         pow(count(*), 0.5) AS weight
  FROM documents GROUP BY 1),
rated AS (
  SELECT name, (weight / (SELECT sum(weight) FROM sources)) * (SELECT sum(n) FROM sources)::DOUBLE / n AS rate
  FROM sources),
steps AS (
  SELECT name, rate, unnest(range(0, CAST(ceil(rate + 10 * sqrt(rate) + 20) AS BIGINT) + 1)) AS k FROM rated),
logs AS (
  SELECT name, rate, k, sum(CASE WHEN k = 0 THEN 0.0 ELSE ln(k::DOUBLE) END)
         OVER (PARTITION BY name ORDER BY k) AS lf FROM steps),
cdf AS (
  SELECT name, rate, k, round(sum(exp(k * ln(rate) - rate - lf)) OVER (PARTITION BY name ORDER BY k), 12) AS c
  FROM logs),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, r.rate,
         (SELECT count(*) FROM cdf WHERE cdf.name = r.name AND cdf.c <=
            ('0x' || substr(md5('17|' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0) AS n
  FROM documents d JOIN rated r ON r.name = CASE WHEN d.source IS NULL THEN '-' ELSE '+' || d.source END)
SELECT doc_id, text, lang, source, n_chars, round(rate, 6) AS rate, copy::INTEGER AS copy,
       md5('17|order|' || coalesce(doc_id::VARCHAR, 'null') || '|' || copy) AS mix_key
FROM (SELECT *, unnest(range(0, n)) AS copy FROM counted)
"""

"""Typed ingest: incoming rows onto the declared schema.

A corpus is a parquet table partitioned by `commit_id`; `quarry.plans.index`
writes its commits and reads them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.schema import BOOL, F64, I64, TEXT, U64, U64_MAX, Schema, SearchError

COMMIT_COL = "commit_id"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_LONG_MIN, _LONG_MAX = -(2 ** 63), 2 ** 63 - 1


def _coerce(src: Column, src_type: T.DataType, field_type: str) -> Column:
    """One field's write coercion. A value of the wrong kind becomes null
    (the document keeps its other fields); nothing raises."""
    is_int = isinstance(src_type, _INTEGRAL)
    is_dec0 = isinstance(src_type, T.DecimalType) and src_type.scale == 0
    if field_type == TEXT:
        return src if isinstance(src_type, T.StringType) else F.lit(None).cast("string")
    if field_type == U64:
        if is_int or is_dec0:
            wide = src.cast("decimal(38,0)")
            return F.when((wide >= 0) & (wide <= F.lit(str(U64_MAX)).cast("decimal(38,0)")),
                          wide.cast("decimal(20,0)"))
        return F.lit(None).cast("decimal(20,0)")
    if field_type == I64:
        if is_int:
            return src.cast("long")
        if is_dec0:
            return F.when((src >= _LONG_MIN) & (src <= _LONG_MAX), src.cast("long"))
        return F.lit(None).cast("long")
    if field_type == F64:
        if is_int or is_dec0 or isinstance(src_type, _FLOATING):
            return src.cast("double")
        return F.lit(None).cast("double")
    if field_type == BOOL:
        return src if isinstance(src_type, T.BooleanType) else F.lit(None).cast("boolean")
    raise SearchError(f"Unsupported field type '{field_type}'")


def ingest(df: DataFrame, schema: Schema, id_col: str = "doc_id") -> DataFrame:
    """Project incoming rows onto the declared schema.

    Unknown columns are dropped, missing fields become null, ill-typed
    values become null. The schema is validated first, on the driver.
    """
    schema.validate()
    if id_col not in df.columns:
        raise SearchError(f"Document id column '{id_col}' not found")
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [F.col(f"`{id_col}`").alias(id_col)]
    for f in schema.fields:
        if f.name == id_col:
            continue
        if f.name in types:
            c = _coerce(F.col(f"`{f.name}`"), types[f.name], f.type)
        else:
            c = F.lit(None).cast(f.spark_type())
        cols.append(c.alias(f.name))
    if COMMIT_COL in df.columns:
        cols.append(F.col(COMMIT_COL).cast("long").alias(COMMIT_COL))
    return df.select(*cols)


def check_ids(corpus: DataFrame, id_col: str) -> None:
    """Refuse a batch in which an id is null or occurs twice: a search sums a
    document's scores by its id, so such rows would be taken for one."""
    bad = (corpus.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.count(F.lit(1)).alias("n"))
                 .where("n > 1 or id is null").limit(1).collect())
    if bad:
        what = "is null" if bad[0]["id"] is None else f"{bad[0]['id']} occurs {bad[0]['n']} times"
        raise SearchError(f"Document id '{id_col}' must be unique: it {what}")

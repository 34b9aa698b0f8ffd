"""Helpers shared by the training-data operators: tables, the shared folder, text bytes."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

# Characters that end a word in the whitespace-separated word rule: \x20 and \x09-\x0D.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends
    there, so a lost executor costs a re-read and not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:6]}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession) -> int:
    """Partitions for an exchange: the session's setting, which the cluster's
    owner sizes for the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """`df` without columns whose names an operator is about to add, so that a
    table with clashing extra columns does not break it."""
    have = {c.lower() for c in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in have])


def apart(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """`df` with those of its columns renamed that have one of the names an
    operator uses, and the way back: columns of any name are carried along."""
    taken, mine, new = {c.lower() for c in df.columns}, {n.lower() for n in names}, {}
    for c in df.columns:
        if c.lower() in mine:
            n = c + "_"
            while n.lower() in taken | mine:
                n += "_"
            taken.add(n.lower())
            new[c] = n
    return df.withColumnsRenamed(new), {n: c for c, n in new.items()}


def ascii_lower(c: Column | str) -> Column:
    """A-Z to a-z, nothing else (`lower` would also map other letters)."""
    return F.translate(c if isinstance(c, Column) else F.col(c),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id: Column | str) -> Column:
    """crc32 of the id as text, mod 5 = 0: the rows no label is learnt from.
    A null id is never learnt from either."""
    c = doc_id if isinstance(doc_id, Column) else F.col(doc_id)
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def strings(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column, null as empty; no copy of
    the text. offsets has one entry more than the column has rows and may
    start above 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1]
    b = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return b, o.astype(np.int64)


def slices(offsets: np.ndarray, limit: int):
    """Cut rows into runs (i, j) of at most `limit` bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j

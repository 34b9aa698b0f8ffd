"""Continuous ingest: every micro-batch becomes one commit of the index.

readStream -> foreachBatch(typed ingest + term table, written as commit
`batch_id`) with a checkpoint. A batch that is replayed after a failure
replaces its own commit instead of duplicating it; readers see a commit once
its marker is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.schema import Schema
from quarry.session import exists
from quarry.sources.corpus import ingest


def ingest_stream(spark: SparkSession, sdf: DataFrame, schema: Schema, path: str,
                  id_col: str = "doc_id", available_now: bool = True,
                  checkpoint: str | None = None, every: str = "10 seconds"):
    """Start (and with available_now, finish) the stream into an index at
    `path`; otherwise a batch starts `every` so often."""
    from quarry.plans.index import Index
    schema.validate()
    if not exists(spark, path + "/meta"):
        Index.create(spark, path, schema, id_col, sdf.schema[id_col].dataType)

    def write_batch(batch: DataFrame, batch_id: int):
        Index._write_commit(batch.sparkSession, ingest(batch, schema, id_col), schema, id_col, path,
                            batch_id, replace=True)

    w = (sdf.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint or path + "/_checkpoint"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q

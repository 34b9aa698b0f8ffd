"""Session helpers: a configured local session for tests and the shared
folder for materialised tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quarry", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Reads `spark.checkpoint.dir` (or the context's checkpoint dir). Only
    when neither is set and the master is local, as in tests, a private
    folder is created: on a cluster it would be another one on each machine.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="quarry-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry/{name}-{uuid.uuid4().hex[:12]}"


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a location, so that any store works."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is missing."""
    fs, p = _hadoop(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def put_text(spark: SparkSession, path: str, text: str = "") -> None:
    """Create a small file through Hadoop (no Spark job)."""
    fs, p = _hadoop(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def get_text(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours (a half-written commit, a scratch index)."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def source_key(df) -> tuple:
    """(file, length, modification time) of the files a table is read from."""
    spark, out = df.sparkSession, []
    for f in sorted(df.inputFiles()):
        fs, p = _hadoop(spark, f)
        st = fs.getFileStatus(p)
        out.append((f, st.getLen(), st.getModificationTime()))
    return tuple(out)


__all__ = ["local_session", "checkpoint_dir", "scratch_path", "exists", "names", "put_text", "get_text",
           "remove", "source_key"]

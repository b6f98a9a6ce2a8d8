"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from stationlake.config import ZONE


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the pipeline's time zone; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", ZONE)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # call sites for error messages cost a JVM round trip per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="stationlake-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder. On a
    cluster a machine-local folder would lose data with its executor, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Let Spark delete the files of shuffles that nothing refers to any more.

    It does so when the driver collects the objects that refer to them, which may be long after;
    a chain of large steps would keep all of them on disk.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*written: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing will read again, and what Spark can let go."""
    for df in written:
        context = df.sparkSession.sparkContext
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            if os.path.basename(folder).startswith("rows-"):
                path = context._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    if written:
        release(written[0].sparkSession)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for what runs inside; it must run there, not later.

    An executor holds a batch outside its heap and the worker holds it once more, so with texts of
    any length it is their number that must be small.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    now = int(spark.conf.get(name, "0") or 0)
    spark.conf.set(name, str(min(now, rows) if now > 0 else rows))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Every later use sees the same rows, and a lost executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

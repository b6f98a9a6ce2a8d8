"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import ctypes.util
import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


@functools.cache
def _archive() -> str:
    """This package as a file that Spark can send to executors."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="stationlake-"), "stationlake.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, os.path.dirname(root)))
    return path


@functools.cache
def _shipped(application: str) -> None:
    SparkSession.active().sparkContext.addPyFile(_archive())


def ship() -> None:
    """Send this package to the workers of the active session, once.

    Workers import it to keep models and caches from task to task; on their own machines they
    may not have it.
    """
    _shipped(SparkSession.active().sparkContext.applicationId)


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that a worker holds the arrays of a few rows only."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


@functools.cache
def _libc() -> ctypes.CDLL | None:
    name = ctypes.util.find_library("c")
    library = ctypes.CDLL(name) if name else None
    return library if hasattr(library, "malloc_trim") else None


def trim() -> None:
    """Give memory that a worker has freed back to the system; workers live from stage to stage."""
    pa.default_memory_pool().release_unused()
    if _libc():
        _libc().malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(prefix: str = "_c") -> str:
    """A column name that no table has."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def exact_key(*columns: str | Column) -> Column:
    """A binary key of 32 bytes; equal for equal values, nulls included."""
    return F.unhex(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))


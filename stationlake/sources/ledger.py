"""Ledgers: small tables of files that say what earlier runs have done.

``history`` has a row for each history file that was loaded, known by its content. ``silver`` has
the event days that each silver run touched, and ``gold`` the silver runs that gold has taken up.
Every run writes a folder of its own, so that running it again replaces its entry.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.sources.readers import read_table

FILES = "fingerprint STRING, file STRING, run_date DATE"
DAYS = "run STRING, anomesdia INT"
TAKEN = "run STRING"


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """``file, fingerprint`` of text files by their content: equal for any copy of a file.

    Lines are hashed where they are read; a file of any size becomes one row. It is made of the
    number of lines, and the sums of two different hashes of each line, so the order of lines
    and how the file is split play no part.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    big = "decimal(38,0)"
    return lines.groupBy("file").agg(
        F.concat_ws(
            "-",
            F.count(F.lit(1)),
            F.sum(F.xxhash64("value").cast(big)),
            F.sum(F.xxhash64(F.reverse("value"), F.length("value")).cast(big)),
        ).alias("fingerprint")
    )


def new_files(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """``file, fingerprint`` of the history files that were not loaded; one of equal files."""
    loaded = read_table(spark, f"{ledger}/history", FILES).select("fingerprint")
    found = file_fingerprints(spark, path).groupBy("fingerprint").agg(F.min("file").alias("file"))
    return found.join(loaded, "fingerprint", "left_anti").select("file", "fingerprint")


def record_files(files: DataFrame, ledger: str, run_date: date) -> None:
    """Remember files as loaded."""
    rows = files.select("fingerprint", "file", F.lit(run_date).alias("run_date"))
    rows.coalesce(1).write.mode("append").parquet(f"{ledger}/history")


def _replace(rows: DataFrame, path: str) -> None:
    """Write the entry of one run over an earlier one of that run."""
    rows = rows.coalesce(1)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def record_days(spark: SparkSession, ledger: str, run: str, days: Collection[int]) -> None:
    """Remember the event days that a silver run touches, a number per calendar day."""
    rows = spark.createDataFrame([(run, d) for d in days] or [(run, None)], DAYS)
    _replace(rows, f"{ledger}/silver")


def changed_days(spark: SparkSession, ledger: str) -> tuple[list[str], list[int]]:
    """The silver runs that gold has not taken up, and the event days that they touched."""
    taken = read_table(spark, f"{ledger}/gold", TAKEN)
    rows = read_table(spark, f"{ledger}/silver", DAYS).join(taken, "run", "left_anti").collect()
    days = {r.anomesdia for r in rows if r.anomesdia is not None}
    return sorted({r.run for r in rows}), sorted(days)


def record_taken(spark: SparkSession, ledger: str, runs: Collection[str]) -> None:
    """Remember silver runs as taken up by gold."""
    if runs:
        rows = spark.createDataFrame([(r,) for r in runs], TAKEN)
        rows.coalesce(1).write.mode("append").parquet(f"{ledger}/gold")

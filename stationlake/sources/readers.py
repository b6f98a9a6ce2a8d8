"""Typed reads. Every reader has a declared schema, so no file is opened to infer one."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.operators.windows import event_day_window, ingestion_window
from stationlake.schemas import BRONZE, BRONZE_COLUMNS, LANDING, PAYLOAD, SILVER


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """Nested station payloads, one JSON record per station."""
    return spark.read.schema(PAYLOAD).json(path)


def read_landing(
    spark: SparkSession, path: str, day: date | str | None = None, schema: str = LANDING
) -> DataFrame:
    """One ingestion day of landed NDJSON, or all of ``path`` if no day is given.

    The day's directory is the root of the read, so neither the day nor the station directory
    becomes a column. A missing directory fails. A broken line gives a row of NULLs, a value
    that does not parse gives NULL, and unknown fields are ignored.
    """
    root = path if day is None else f"{path.rstrip('/')}/ingestion_date={day}"
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(root)


def read_history_csv(spark: SparkSession, path: str, schema: str = LANDING) -> DataFrame:
    """History files: header line, comma, columns in landing order.

    A header with other names or another order fails, as columns are read by position.
    """
    options = {"header": "true", "sep": ",", "enforceSchema": "false"}
    return spark.read.schema(schema).options(**options).csv(path)


#: The text of a record that does not fit the schema, and the file that it is from.
RECORD, FILE = "_record", "_file"


def read_landing_records(
    spark: SparkSession, path: str, day: date | str | None = None, schema: str = LANDING
) -> DataFrame:
    """``read_landing`` with the text of records that do not fit, and every row's file.

    A line that is no JSON, or has a value of another type, has its text in ``_record``; for all
    other rows it is NULL. Lines are parsed whole whatever columns are used later: a reader that
    skips a column does not see what is wrong with it.
    """
    root = path if day is None else f"{path.rstrip('/')}/ingestion_date={day}"
    lines = spark.read.option("recursiveFileLookup", "true").text(root)
    options = {"columnNameOfCorruptRecord": RECORD}
    parsed = F.from_json("value", f"{schema}, {RECORD} STRING", options).alias("parsed")
    rows = lines.where(F.trim("value") != "").select(parsed, F.col("_metadata.file_path").alias(FILE))
    return rows.select("parsed.*", FILE)


def read_history_records(
    spark: SparkSession, path: str | list[str], schema: str = LANDING
) -> DataFrame:
    """``read_history_csv`` with rejected records as in ``read_landing_records``.

    A row with too few or too many fields, or with a value of another type, is rejected.
    """
    options = {
        "header": "true", "sep": ",", "enforceSchema": "false",
        "columnNameOfCorruptRecord": RECORD,
    }
    records = spark.read.schema(f"{schema}, {RECORD} STRING").options(**options).csv(path)
    # always true, but it has Spark read and check all columns
    whole = F.bit_count(F.xxhash64(*[c for c in records.columns if c != RECORD])) >= 0
    return records.where(whole).select("*", F.col("_metadata.file_path").alias(FILE))


def split_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the rejected records as ``location_id, record, file``."""
    good = records.where(F.col(RECORD).isNull()).drop(RECORD, FILE)
    rejected = records.where(F.col(RECORD).isNotNull()).select(
        "location_id", F.col(RECORD).alias("record"), F.col(FILE).alias("file")
    )
    return good, rejected


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """``file, n_rejected`` of the files with rejected records."""
    return rejected.groupBy("file").agg(F.count("record").alias("n_rejected"))


def read_bronze_window(
    spark: SparkSession, path: str, run_date: date, days: int, schema: str = BRONZE
) -> DataFrame:
    """Bronze rows of the last ``days`` ingestion days; other partitions are not read."""
    bronze = spark.read.schema(schema).parquet(path).select(*BRONZE_COLUMNS)
    return ingestion_window(bronze, run_date, days)


def read_silver_window(
    spark: SparkSession, path: str, run_date: date, days: int, schema: str = SILVER
) -> DataFrame:
    """Silver rows of the last ``days`` event days; other partitions are not read.

    A silver folder that is not there fails: an input that is missing is not an empty one.
    """
    silver = spark.read.schema(schema).parquet(path)
    columns = spark.createDataFrame([], schema).columns
    return event_day_window(silver.select(*columns), run_date, days)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A target table in its declared column order; without rows before its first load."""
    empty = spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(path).select(*empty.columns)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise

"""The physical plans are the ones meant."""

import re
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from stationlake import operators as op
from stationlake.plans import jobs, registry
from stationlake.schemas import BRONZE, READING_KEYS, SILVER
from stationlake.sources import append_bucketed, read_bronze_window, read_silver_window
from stationlake.sources import stand_in as src


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for large inputs."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize(
    "query", ["daily_extremes", "daily_extremes_lineitem", "daily_extremes_lineitem_status"]
)
def test_extremes_cut_batches_and_then_shuffle_and_sort_once(spark, sf_dir, no_broadcast, query):
    text = plan(registry.queries()[query](spark, sf_dir))
    assert text.count("FileScan") == text.count("MapInArrow cut") == 1
    assert text.count("Exchange") == text.count("+- Sort [") == 1
    assert text.index("Exchange") < text.index("MapInArrow cut")  # plans read from the bottom
    assert "Join" not in text


def test_extremes_read_few_columns(spark, sf_dir):
    text = plan(registry.daily_extremes_lineitem(spark, sf_dir))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert all("l_orderkey" not in s and "l_tax" not in s for s in schemas)


def test_dedupe_shuffles_once_after_a_local_cut(spark, sf_dir):
    text = plan(registry.dedupe_lineitem(spark, sf_dir))
    assert text.count("Exchange") == 1
    assert len(re.findall(r"WindowGroupLimit.*Partial", text)) == 1


def test_counts_are_combined_before_the_shuffle(spark, sf_dir):
    text = plan(registry.landed_counts(spark, sf_dir))
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_lookups_do_not_shuffle_the_readings(spark, sf_dir):
    text = plan(op.conform_readings(src.events_as_readings(spark, sf_dir)))
    assert text.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in text


def test_merge_is_one_anti_join(spark, no_broadcast):
    left = spark.range(10).select("id", F.lit(1).alias("v"))
    text = plan(op.merge_insert_only(left.where("id > 3"), left, ["id"]))
    assert text.count("LeftAnti") == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_target_rows_are_looked_up_in_bitmaps_before_the_shuffle(spark, sf_dir, no_broadcast):
    text = plan(registry.merge_insert_only_pruned(spark, sf_dir))
    exchanges = [m.start() for m in re.finditer("Exchange hashpartitioning", text)]
    bitmaps = text.index("BroadcastHashJoin")
    # the source's dedupe and the target's filter: below the target's exchange is the bitmap join
    assert text.count("LeftAnti") == 1 and text.count("bitmap_construct_agg") >= 2
    assert any(e < bitmaps for e in exchanges) and text.index("LeftAnti") < bitmaps


def test_silver_merge_keeps_the_partitioning_of_the_dedupe(spark, sf_dir):
    bronze = src.events_with_repeats(spark, sf_dir)
    batch = jobs.silver_batch(bronze, registry.CONFIG)
    target = spark.createDataFrame([], batch.schema).hint("merge")
    assert plan(batch).count("Exchange hashpartitioning") == 1
    # only the target side is added
    merged = plan(op.merge_insert_only(target, batch, READING_KEYS))
    assert merged.count("Exchange hashpartitioning") == 2


def test_a_bucketed_target_is_not_shuffled(spark, sf_dir, no_broadcast, view):
    silver = src.events_as_silver(spark, sf_dir).drop("event_id")
    append_bucketed(silver, view, READING_KEYS, 8)
    bronze = src.events_with_repeats(spark, sf_dir)
    batch = jobs.silver_batch(bronze, registry.CONFIG).where("anomesdia >= 20240128")
    target = spark.table(view).where("anomesdia >= 20240128")
    text = plan(op.merge_insert_only(target, batch, READING_KEYS))
    # the one exchange is that of the batch's dedupe, which has as many partitions
    assert text.count("LeftAnti") == text.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in text
    spark.sql(f"DROP TABLE {view}")


@pytest.mark.parametrize("hot", ["CAST(NULL AS BIGINT)", "CAST(7 AS BIGINT)"])
def test_merge_splits_a_hot_source_key(spark, no_broadcast, hot):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 60000, 1, 8).select(
            F.expr(f"IF(id % 3 = 0, {hot}, id)").alias("k"), F.hash("id").alias("v")
        )
        target = spark.range(100, 200).select(F.col("id").alias("k"), F.lit(0).alias("v"))
        merged = op.merge_insert_only(target, rows, ["k"])
        assert len(merged.collect()) == 60000 - 67
        assert "skew=true" in plan(merged)
    finally:
        for key in settings:
            spark.conf.unset(key)


SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def test_a_large_dimension_is_joined_by_shuffle_and_a_hot_station_split(spark, tmp_path):
    # 40 MB of names: beyond the threshold of broadcasts, which is left as it is
    dim = spark.range(0, 2000, 1, 4).select(
        F.col("id").alias("station_id"),
        F.expr("array_join(transform(sequence(1, 160), i -> sha2(concat(id, '-', i), 512)), '')")
        .alias("station_name"),
    )
    dim.write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    readings = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 3000).alias("location_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("location"),
    )
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    try:
        joined = op.canonical_station(readings, dim).withColumn("n", F.length("location"))
        named = joined.select("location_id", "n")
        assert Counter(r.n > 64 for r in named.collect()) == {True: 46660, False: 13340}
        joined = op.canonical_station(readings, dim)
        joined = joined.select("location_id", F.length("location").alias("n"))
        joined.collect()
        text = plan(joined)
        assert "BroadcastHashJoin" not in text and "skew=true" in text
    finally:
        for key in SKEW:
            spark.conf.unset(key)


def test_silver_prunes_the_registered_bronze_table(spark, tmp_path, view):
    spark.sql(
        f"CREATE TABLE {view} ({BRONZE}) USING parquet "
        f"PARTITIONED BY (data_ingestao) LOCATION '{tmp_path}/bronze'"
    )
    text = plan(op.ingestion_window(spark.table(view), date(2024, 1, 30), 3))
    assert re.search(r"PartitionFilters: \[.*data_ingestao.*>= 2024-01-28", text)
    spark.sql(f"DROP TABLE {view}")


def test_bronze_window_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "bronze")
    one = spark.createDataFrame([(None,) * 10 + (date(2024, 1, 1),)], BRONZE)
    one.write.partitionBy("data_ingestao").parquet(path)
    text = plan(read_bronze_window(spark, path, date(2024, 1, 30), 3))
    assert re.search(r"PartitionFilters: \[.*data_ingestao.*>= 2024-01-28", text)


def test_silver_window_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    one = spark.createDataFrame([(None,) * 11 + (20240101, None)], SILVER)
    one.write.partitionBy("anomesdia").parquet(path)
    text = plan(read_silver_window(spark, path, date(2024, 1, 30), 3))
    assert re.search(r"PartitionFilters: \[.*anomesdia.*>= 20240128", text)


# these run jobs or write files; the plans of their parts are covered by the others
WRITING = {
    "landing_roundtrip", "history_csv_roundtrip", "bronze_rerun_idempotent", "bronze_window",
    "gold_from_silver", "jobs_bronze_to_gold", "jobs_silver_twice", "silver_window",
    "bronze_window_table", "jobs_landing_counts", "jobs_landing_to_bronze", "jobs_history",
    "jobs_gold_replace_days", "jobs_silver_bucketed", "jobs_changed_days", "jobs_incremental",
    "jobs_rejected",
}


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - WRITING))
def test_no_query_takes_rows_to_python_one_by_one_or_gathers_them(spark, sf_dir, name):
    text = plan(registry.queries()[name](spark, sf_dir))
    for word in ("Python", "Pandas", "SinglePartition", "CartesianProduct"):
        assert word not in text
    # rankings join the ranges that continue a group, at most one row per range
    if not name.startswith("rank_"):
        assert "NestedLoop" not in text
    # every query reads its tables whole
    for word in ("GlobalLimit", "LocalLimit", "CollectLimit", "TakeOrdered", "Sample"):
        assert word not in text


def test_days_are_sorted_once_for_the_writer(spark, sf_dir, tmp_path):
    spark.sql(
        "CREATE TABLE sorted_days (id_sensor BIGINT, valor DOUBLE, anomesdia INT) USING parquet "
        f"PARTITIONED BY (anomesdia) LOCATION '{tmp_path}/t'"
    )
    rows = src.events_as_silver(spark, sf_dir).select("id_sensor", "valor", "anomesdia")
    by_day = rows.hint("rebalance", F.col("anomesdia"))
    by_day.sortWithinPartitions("anomesdia", "id_sensor").createOrReplaceTempView("day_rows")
    (line,) = spark.sql("EXPLAIN INSERT INTO sorted_days SELECT * FROM day_rows").collect()
    assert line[0].count("Sort [") == 1
    spark.sql("DROP TABLE sorted_days")

"""Readers and writers over a temporary lake."""

import glob
import gzip
import json
import os
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stationlake import sources as src
from stationlake.operators import tag_ingestion
from stationlake.schemas import BRONZE_COLUMNS, LANDING, LANDING_COLUMNS
from stationlake.sources import (
    append_days,
    append_history,
    merge_catalog_table,
    read_bronze_window,
    read_history_csv,
    read_landing,
    read_silver_window,
    read_table,
    register_partition,
    write_bronze_day,
    write_landing,
)

DAY = date(2024, 1, 30)


def landed(spark, *rows):
    return spark.createDataFrame(list(rows), LANDING)


def reading(station, sensor=1, value=1.0, at=datetime(2024, 1, 30, 5)):
    return (station, sensor, "n", at, 1.0, 2.0, "pm25", "u", value)


def write_gz(path, lines):
    os.makedirs(os.path.dirname(path))
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")


def test_read_landing_is_permissive_and_typed(spark, lake):
    line = {
        "location_id": 1, "sensors_id": 2, "location": "São", "lat": 1.0, "lon": 2.0,
        "datetime": "2026-09-30T23:30:00-03:00", "parameter": "o3", "units": "u", "value": 3.5,
    }
    path = lake["landing_path"]
    write_gz(
        f"{path}/ingestion_date=2024-01-30/location-1.ndjson.gz",
        [
            json.dumps(line, ensure_ascii=False),
            json.dumps({k: v for k, v in line.items() if k != "location_id"}),
            json.dumps(line | {"value": "x"}),
            "{broken",
            json.dumps(line | {"extra": 1}),
        ],
    )
    write_gz(f"{path}/ingestion_date=2024-01-31/location-1.ndjson.gz", [json.dumps(line)])
    df = read_landing(spark, path, DAY)
    assert df.columns == LANDING_COLUMNS
    got = df.collect()
    assert len(got) == 5
    by = Counter((r.location_id, r.value) for r in got)
    assert by == Counter({(1, 3.5): 2, (None, 3.5): 1, (1, None): 1, (None, None): 1})
    assert got[0].location == "São"
    instant = df.select(F.unix_timestamp("datetime")).first()[0]
    assert instant == 1790821800  # 2026-10-01T02:30:00Z
    assert sum(all(v is None for v in r) for r in got) == 1


def test_read_landing_needs_the_day(spark, lake):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_landing(spark, lake["landing_path"], DAY)


def test_landing_has_one_gzip_file_per_station(spark, lake):
    path = lake["landing_path"]
    df = landed(spark, *[reading(s, v) for s in range(20) for v in range(30)])
    write_landing(df.repartition(7), path, DAY)
    files = glob.glob(f"{path}/ingestion_date=2024-01-30/station=*/*.json.gz")
    assert len(files) == len({os.path.dirname(f) for f in files}) == 20
    with gzip.open(files[0], "rt") as text:
        record = json.loads(text.readline())
    assert set(record) == set(LANDING_COLUMNS)


def test_landing_again_replaces_only_the_stations_present(spark, lake):
    path = lake["landing_path"]
    write_landing(landed(spark, reading(1, value=1.0), reading(2, value=1.0)), path, DAY)
    write_landing(landed(spark, reading(2, value=9.0)), path, DAY)
    got = read_landing(spark, path, DAY).select("location_id", "value").collect()
    assert sorted(map(tuple, got)) == [(1, 1.0), (2, 9.0)]


def test_large_stations_are_cut_into_several_files(spark, lake):
    path = lake["landing_path"]
    write_landing(landed(spark, *[reading(1, s) for s in range(25)]), path, DAY, 10)
    assert len(glob.glob(f"{path}/*/station=1/*.gz")) == 3
    assert read_landing(spark, path, DAY).count() == 25


def test_landing_keeps_nulls_and_microseconds(spark, lake):
    path = lake["landing_path"]
    exact = datetime(2024, 1, 30, 5, 0, 0, 123456)
    df = landed(spark, reading(1, at=exact), (None,) * 9, (1, None, None, None, *[None] * 5))
    write_landing(df, path, DAY)
    (name,) = glob.glob(f"{path}/*/station=1/*.gz")
    with gzip.open(name, "rt") as text:
        assert all(set(json.loads(line)) == set(LANDING_COLUMNS) for line in text)
    got = Counter(map(tuple, read_landing(spark, path, DAY).collect()))
    assert got == Counter(map(tuple, df.collect()))


def test_history_csv(spark, lake):
    os.makedirs(lake["history_path"])
    with open(f"{lake['history_path']}/a.csv", "w") as out:
        out.write(",".join(LANDING_COLUMNS) + "\n")
        out.write('1,2,"A, B",2024-01-01T05:00:00-03:00,1.5,2.5,pm25,u,7.5\n')
        out.write("x,2,C,never,1.5,2.5,pm25,u,\n")
    first, second = sorted(
        read_history_csv(spark, lake["history_path"]).collect(), key=lambda r: r.location
    )
    assert (first.location_id, first.location, first.value) == (1, "A, B", 7.5)
    assert first.datetime is not None
    assert (second.location_id, second.datetime, second.value) == (None, None, None)


def bronze(spark, path, days=0):
    return read_bronze_window(spark, path, DAY, days)


def test_bronze_day_is_replaced_and_others_stay(spark, lake):
    path = lake["bronze_path"]
    before = date(2024, 1, 29)
    write_bronze_day(tag_ingestion(landed(spark, reading(1)), "api", before), path)
    for value in (1.0, 2.0):
        df = landed(spark, reading(1, value=value), reading(2, value=value))
        write_bronze_day(tag_ingestion(df, "api", DAY), path)
    got = bronze(spark, path)
    assert got.columns == BRONZE_COLUMNS
    counts = Counter((r.data_ingestao, r.value) for r in got.collect())
    assert counts == Counter({(before, 1.0): 1, (DAY, 2.0): 2})


def test_an_empty_batch_removes_nothing(spark, lake):
    path = lake["bronze_path"]
    write_bronze_day(tag_ingestion(landed(spark, reading(1)), "api", DAY), path)
    write_bronze_day(tag_ingestion(landed(spark), "api", DAY), path)
    assert bronze(spark, path).count() == 1


def test_bronze_partitioned_by_day_alone_can_be_read(spark, lake):
    df = tag_ingestion(landed(spark, reading(1)), "api", DAY)
    df.write.partitionBy("data_ingestao").parquet(lake["bronze_path"])
    assert bronze(spark, lake["bronze_path"], 1).collect() == df.collect()


def test_the_daily_write_keeps_history_of_the_same_day(spark, lake):
    path = lake["bronze_path"]
    append_history(tag_ingestion(landed(spark, reading(1)), "historico_csv", DAY), path)
    write_bronze_day(tag_ingestion(landed(spark, reading(2)), "api", DAY), path)
    kinds = sorted(r.tipo_ingestao for r in bronze(spark, path).collect())
    assert kinds == ["api", "historico_csv"]


def test_appending_history_twice_duplicates(spark, lake):
    history = tag_ingestion(landed(spark, reading(1)), "historico_csv", DAY)
    append_history(history, lake["bronze_path"])
    append_history(history, lake["bronze_path"])
    assert bronze(spark, lake["bronze_path"]).count() == 2


def test_registering_a_partition_shows_it_once(spark, lake, view):
    path = lake["bronze_path"]
    columns = LANDING + ", tipo_ingestao STRING, data_ingestao DATE"
    spark.sql(
        f"CREATE TABLE {view} ({columns}) USING parquet "
        f"PARTITIONED BY (data_ingestao, tipo_ingestao) LOCATION '{path}'"
    )
    write_bronze_day(tag_ingestion(landed(spark, reading(1)), "api", DAY), path)
    assert spark.table(view).count() == 0
    register_partition(spark, view, DAY, "api")
    register_partition(spark, view, "2024-01-30", "api")
    assert spark.table(view).count() == 1
    spark.sql(f"DROP TABLE {view}")


def test_missing_tables_read_as_empty(spark, lake):
    df = read_table(spark, lake["silver_path"], "a INT, anomesdia INT")
    assert df.columns == ["a", "anomesdia"] and df.count() == 0
    with pytest.raises(AnalysisException):
        read_table(spark, lake["silver_path"], "a INT").select("missing")


def test_silver_window_reads_its_days(spark, lake):
    schema = "v INT, anomesdia INT"
    df = spark.createDataFrame([(1, 20240127), (2, 20240128), (3, 20240130)], schema)
    df.write.partitionBy("anomesdia").parquet(lake["silver_path"])

    def read(days):
        return sorted(
            r.v for r in read_silver_window(spark, lake["silver_path"], DAY, days, schema).collect()
        )

    assert read(3) == [2, 3]
    assert read(0) == [1, 2, 3]


def test_a_hot_day_is_written_by_several_tasks(spark, lake):
    path = lake["silver_path"]
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        df = spark.range(0, 200000, 1, 4).select(
            F.hash("id").alias("v"),
            F.when(F.col("id") % 20 == 0, 20240101 + F.col("id") % 7)
            .otherwise(20240130)
            .cast("int")
            .alias("anomesdia"),
        )
        append_days(df, path, order=["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{path}/anomesdia=20240130/*.parquet")) > 3
    assert len(glob.glob(f"{path}/anomesdia=20240101/*.parquet")) == 1
    assert spark.read.parquet(path).count() == 200000
    (small,) = glob.glob(f"{path}/anomesdia=20240101/*.parquet")
    values = [r.v for r in spark.read.parquet(small).collect()]
    assert values == sorted(values)


def test_merging_into_a_plain_catalog_table_is_refused(spark, view):
    spark.sql(f"CREATE TABLE {view} (k INT, anomesdia INT) USING parquet")
    df = spark.createDataFrame([(1, 1)], "k INT, anomesdia INT")
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        merge_catalog_table(df, view, ["k"])
    spark.sql(f"DROP TABLE {view}")


def test_a_history_header_in_another_order_fails(spark, tmp_path):
    names = "sensors_id,location_id,location,datetime,lat,lon,parameter,units,value"
    (tmp_path / "a.csv").write_text(f"{names}\n1,2,x,2020-05-01T01:00:00-03:00,1,2,o3,u,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_history_csv(spark, str(tmp_path)).collect()


LINES = [
    '{"location_id": 1, "sensors_id": 2, "location": "x", "datetime": "2024-01-29T00:00:00Z", "value": 1.5}',
    "{broken",
    "",
    '{"location_id": 2, "value": "far"}',
    '{"location_id": 3, "value": 2.5, "more": [1]}',
    '{"location_id": "three"}',
    "[]",
    "null",
]


def test_records_that_do_not_fit_are_set_aside(spark, tmp_path):
    day = tmp_path / "landing/ingestion_date=2024-01-30/station=1"
    day.mkdir(parents=True)
    (day / "a.json").write_text("\n".join(LINES))
    (day / "b.json").write_text(LINES[0] + "\n" + LINES[1])
    records = src.read_landing_records(spark, str(tmp_path / "landing"), date(2024, 1, 30))
    good, rejected = src.split_records(records)
    assert good.columns == LANDING_COLUMNS
    assert sorted(r.location_id for r in good.select("location_id").collect()) == [1, 1, 3]
    assert good.count() == 3 and good.where("value IS NULL").count() == 0
    texts = sorted(r.record for r in rejected.select("record").collect())
    assert texts == sorted([LINES[1], LINES[1], LINES[3], LINES[5], LINES[6], LINES[7]])
    counts = {r.file.rsplit("/", 1)[1]: r.n_rejected for r in src.rejected_counts(rejected).collect()}
    assert counts == {"a.json": 5, "b.json": 1}


def test_history_rows_that_do_not_fit_are_set_aside(spark, tmp_path):
    header = ",".join(LANDING_COLUMNS)
    fine = "1,2,x,2024-01-29T00:00:00Z,1.5,2.5,p,u,3.5"
    bad = ["1,2,x", fine.replace("1.5", "far"), fine + ",9", fine.replace("2024", "soon")]
    (tmp_path / "h.csv").write_text("\n".join([header, fine, *bad, fine.replace(",2.5", ",")]))
    good, rejected = src.split_records(src.read_history_records(spark, str(tmp_path)))
    # also when few columns are read
    assert good.count() == 2
    assert [r.value for r in good.select("value").collect()] == [3.5, 3.5]
    assert sorted(r.record for r in rejected.select("record").collect()) == sorted(bad)
    assert src.rejected_counts(rejected).first().n_rejected == 4


def test_fingerprints_know_a_file_by_its_content(spark, tmp_path):
    for name, lines in {"a": "xyz", "b": "zyx", "c": "xxyz", "d": "xy", "e": ""}.items():
        (tmp_path / f"{name}.csv").write_text("".join(f"{c}\n" for c in lines))
    found = {r.file[-5]: r.fingerprint for r in src.file_fingerprints(spark, str(tmp_path)).collect()}
    assert found["a"] == found["b"] and len(set(found.values())) == 3
    ledger = str(tmp_path / "ledger")
    src.record_files(src.new_files(spark, str(tmp_path / "*.csv"), ledger).where("file LIKE '%/c.csv'"), ledger, date(2024, 1, 1))
    left = src.new_files(spark, str(tmp_path / "*.csv"), ledger).collect()
    assert sorted(r.file[-5] for r in left) == ["a", "d"]


def test_ledger_of_days(spark, tmp_path):
    ledger = str(tmp_path)
    assert src.changed_days(spark, ledger) == ([], [])
    src.record_days(spark, ledger, "one", [20240101, 20240102, 20240103])
    src.record_days(spark, ledger, "one", [20240102])
    src.record_days(spark, ledger, "two", [20240102, 20240105])
    src.record_days(spark, ledger, "three", [])
    assert src.changed_days(spark, ledger) == (["one", "three", "two"], [20240102, 20240105])
    src.record_taken(spark, ledger, ["one", "three"])
    assert src.changed_days(spark, ledger) == (["two"], [20240102, 20240105])
    src.record_taken(spark, ledger, ["two"])
    assert src.changed_days(spark, ledger) == ([], [])

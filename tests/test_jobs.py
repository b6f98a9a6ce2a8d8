"""The jobs end to end over a temporary lake."""

import json
import os
from collections import Counter
from dataclasses import replace
from datetime import date, datetime
from zoneinfo import ZoneInfo

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException

from stationlake import PipelineConfig
from stationlake.operators import checks
from stationlake.plans import incremental, jobs
from stationlake.schemas import (
    BRONZE,
    GOLD_KEYS,
    LANDING,
    READING_KEYS,
    SILVER,
    SILVER_COLUMNS,
    gold_schema,
)
from stationlake.sources import read_bronze_window, read_table, write_landing

ZONE = ZoneInfo("America/Sao_Paulo")


def config(lake, day=30, **kwargs):
    run_at = datetime(2024, 1, day, 10, tzinfo=ZONE)
    # rows with a NULL key stay in the flow unless a test asks for a quarantine
    return PipelineConfig(run_at=run_at, **({**lake, "quarantine_path": ""} | kwargs))


def payload(lake, *stations):
    os.makedirs(lake["payload_path"], exist_ok=True)
    with open(f"{lake['payload_path']}/p.json", "w") as out:
        for station in stations:
            out.write(json.dumps(station, ensure_ascii=False) + "\n")


def measured(at, value, code="pm25"):
    return {
        "period": {"datetimeTo": {"local": at}},
        "parameter": {"name": code, "units": "u"},
        "value": value,
    }


def station(number, name, *sensors):
    return {
        "id": number,
        "name": name,
        "coordinates": {"latitude": -22.9, "longitude": -43.2},
        "sensors": [{"id": i, "measurements": list(m)} for i, m in sensors],
    }


def silver(spark, lake):
    return read_table(spark, lake["silver_path"], SILVER)


def gold(spark, lake):
    return read_table(spark, lake["gold_path"], gold_schema())


def run_all(spark, cfg):
    counts = jobs.run_landing(spark, cfg)
    jobs.run_bronze_daily(spark, cfg)
    jobs.run_silver(spark, cfg)
    jobs.run_gold(spark, cfg)
    return {r.location_id: r.n_rows for r in counts.collect()}


HOURS = [measured(f"2024-01-29T{h:02d}:00:00-03:00", float(h)) for h in range(1, 6)]


def test_a_day_through_all_layers(spark, lake):
    payload(
        lake,
        station(820321, "bangu raw", (1, HOURS), (2, HOURS[:1])),
        station(3911519, "Toronto", (9, HOURS)),
        station(77, "unlisted", (7, HOURS[:2])),
        station(88, "silent"),
    )
    cfg = config(lake)
    assert run_all(spark, cfg) == {820321: 6, 3911519: 5, 77: 2}

    rows = silver(spark, lake)
    assert rows.columns == SILVER_COLUMNS
    names = Counter((r.id_localizacao, r.localizacao) for r in rows.collect())
    assert names == Counter({(820321, "Bangu"): 6, (77, "unlisted"): 2})

    got = {(r.id_localizacao, r.id_sensor): tuple(r)[7:] for r in gold(spark, lake).collect()}
    assert got == {
        (820321, 1): (5.0, 4.0, 3.0, 1.0, 2.0, 3.0),
        (820321, 2): (1.0, None, None, 1.0, None, None),
        (77, 7): (2.0, 1.0, None, 1.0, 2.0, None),
    }
    assert {r.parametro_descricao for r in gold(spark, lake).collect()} == {"Partículas finas"}


def test_runs_are_idempotent_over_overlapping_windows(spark, lake):
    payload(lake, station(820321, "x", (1, HOURS)))
    run_all(spark, config(lake, 30))
    before = silver(spark, lake).collect(), gold(spark, lake).collect()
    run_all(spark, config(lake, 30))
    run_all(spark, config(lake, 31))
    bronze = read_bronze_window(spark, lake["bronze_path"], date(2024, 1, 31), 0)
    assert bronze.count() == 10
    assert Counter(silver(spark, lake).collect()) == Counter(before[0])
    assert Counter(gold(spark, lake).collect()) == Counter(before[1])


def test_the_first_write_of_a_reading_stays(spark, lake):
    payload(lake, station(820321, "x", (1, HOURS)))
    run_all(spark, config(lake, 30))
    payload(lake, station(820321, "x", (1, [measured("2024-01-29T01:00:00-03:00", 99.0)])))
    run_all(spark, config(lake, 31))
    assert sorted(r.valor for r in silver(spark, lake).collect()) == [1.0, 2.0, 3.0, 4.0, 5.0]


def test_late_readings_reach_gold_only_on_replacement(spark, lake):
    other_day = measured("2024-01-28T05:00:00-03:00", 50.0)
    payload(lake, station(820321, "x", (1, [*HOURS, other_day])))
    run_all(spark, config(lake, 30))
    payload(lake, station(820321, "x", (1, [measured("2024-01-29T22:00:00-03:00", 99.0)])))
    run_all(spark, config(lake, 31))

    def top():
        return {r.anomesdia: r.top1_valor for r in gold(spark, lake).collect()}

    assert silver(spark, lake).where("valor = 99").count() == 1
    assert top() == {20240128: 50.0, 20240129: 5.0}
    jobs.run_gold(spark, config(lake, 31, gold_mode="replace_days", gold_days=3))
    assert top() == {20240128: 50.0, 20240129: 99.0}
    jobs.run_gold(spark, config(lake, 31, gold_mode="replace_days", gold_days=0))
    assert top() == {20240128: 50.0, 20240129: 99.0}
    assert gold(spark, lake).count() == 2


def test_the_landing_interval(spark, lake):
    payload(
        lake,
        station(
            1,
            "x",
            (
                1,
                [
                    measured("2024-01-26T23:59:59-03:00", 1.0),
                    measured("2024-01-27T00:00:00-03:00", 2.0),
                    measured("2024-01-27T00:00:00-02:00", 3.0),
                    measured("2024-01-30T10:00:00-03:00", 4.0),
                    measured("2024-01-30T10:00:01-03:00", 5.0),
                    {"value": 6.0},
                ],
            ),
        ),
    )
    cfg = config(lake)
    assert {r.n_rows for r in jobs.run_landing(spark, cfg).collect()} == {3}
    jobs.run_bronze_daily(spark, cfg)
    bronze = read_bronze_window(spark, lake["bronze_path"], cfg.run_date, 1)
    assert sorted(r.value for r in bronze.collect()) == [2.0, 4.0, 6.0]


TIMELESS = {"period": None, "parameter": {"name": "o3", "units": "u"}, "value": 1.0}


def test_readings_without_a_time_come_back_every_run(spark, lake):
    payload(lake, station(820321, "x", (1, [*HOURS, TIMELESS, TIMELESS])))
    for _ in range(2):
        run_all(spark, config(lake))
    assert silver(spark, lake).where("data_hora IS NULL").count() == 2
    assert silver(spark, lake).count() == 7


def test_readings_without_a_time_can_be_set_aside(spark, lake):
    payload(lake, station(820321, "x", (1, [*HOURS, TIMELESS, TIMELESS])))
    for _ in range(2):
        run_all(spark, config(lake, quarantine_path=lake["quarantine_path"]))
    assert silver(spark, lake).count() == 5
    aside = spark.read.parquet(f"{lake['quarantine_path']}/silver")
    assert aside.count() == 1
    assert {r.run_date for r in aside.collect()} == {date(2024, 1, 30)}


def test_history_joins_the_flow(spark, lake):
    os.makedirs(lake["history_path"])
    with open(f"{lake['history_path']}/a.csv", "w") as out:
        out.write("location_id,sensors_id,location,datetime,lat,lon,parameter,units,value\n")
        for hour in range(1, 4):
            out.write(f"820321,1,raw,2020-05-01T0{hour}:00:00-03:00,1,2,pm25,u,{hour}\n")
    cfg = config(lake, silver_days=0, gold_days=0)
    jobs.run_bronze_history(spark, cfg)
    payload(lake, station(820321, "x", (1, HOURS)))
    run_all(spark, cfg)
    days = {r.anomesdia: r.top1_valor for r in gold(spark, lake).collect()}
    assert days == {20200501: 3.0, 20240129: 5.0}
    kinds = Counter(r.tipo_ingestao for r in silver(spark, lake).collect())
    assert kinds == Counter({"api": 5, "historico_csv": 3})


def test_a_registered_table_shows_both_origins(spark, lake, view):
    spark.sql(
        f"CREATE TABLE {view} (location_id BIGINT, sensors_id BIGINT, location STRING, "
        "datetime TIMESTAMP, lat DOUBLE, lon DOUBLE, parameter STRING, units STRING, "
        "value DOUBLE, tipo_ingestao STRING, data_ingestao DATE) USING parquet "
        f"PARTITIONED BY (data_ingestao, tipo_ingestao) LOCATION '{lake['bronze_path']}'"
    )
    os.makedirs(lake["history_path"])
    with open(f"{lake['history_path']}/a.csv", "w") as out:
        out.write("location_id,sensors_id,location,datetime,lat,lon,parameter,units,value\n")
        out.write("820321,1,raw,2020-05-01T01:00:00-03:00,1,2,pm25,u,1\n")
    payload(lake, station(820321, "x", (1, HOURS)))
    cfg = config(lake, bronze_table=view)
    jobs.run_landing(spark, cfg)
    jobs.run_bronze_daily(spark, cfg)
    jobs.run_bronze_history(spark, cfg)
    kinds = Counter(r.tipo_ingestao for r in spark.table(view).collect())
    assert kinds == Counter({"api": 5, "historico_csv": 1})
    spark.sql(f"DROP TABLE {view}")


def test_catalog_tables_take_the_place_of_paths(spark, lake, view, monkeypatch):
    payload(lake, station(820321, "x", (1, HOURS)))
    run_all(spark, config(lake))
    spark.sql(
        f"CREATE TABLE {view} ({SILVER}) USING parquet PARTITIONED BY (anomesdia) "
        f"LOCATION '{lake['silver_path']}'"
    )
    spark.catalog.recoverPartitions(view)
    merged = []
    monkeypatch.setattr(
        jobs, "merge_catalog_table", lambda df, table, keys: merged.append((df, table, keys))
    )
    cfg = config(lake, silver_table=view, gold_table="catalog.db.gold")
    jobs.run_silver(spark, cfg)
    jobs.run_gold(spark, cfg)
    (batch, table, keys), (extremes, gold_table, gold_keys) = merged
    assert (table, gold_table) == (view, "catalog.db.gold")
    assert (keys, gold_keys) == (READING_KEYS, GOLD_KEYS)
    assert batch.columns == SILVER_COLUMNS and batch.count() == 5
    assert extremes.collect() == gold(spark, lake).collect()
    spark.sql(f"DROP TABLE {view}")


def test_split_windows_equal_the_whole(spark, lake, tmp_path):
    payload(lake, station(820321, "x", (1, [*HOURS, measured("2024-01-28T05:00:00-03:00", 7.0)])))
    cfg = config(lake)
    run_all(spark, cfg)
    whole = Counter(gold(spark, lake).collect())
    for days in (1, 2, 3, 0):
        other = {**lake, "gold_path": str(tmp_path / f"gold-{days}")}
        jobs.run_gold(spark, config(other, gold_days=days))
        got = Counter(gold(spark, other).collect())
        assert got <= whole
        assert got == whole if days in (3, 0) else got != whole


def test_the_clock_is_read_once():
    cfg = PipelineConfig(run_at=datetime(2024, 1, 31, 1, tzinfo=ZoneInfo("UTC")))
    assert cfg.run_date == date(2024, 1, 30)
    assert PipelineConfig.now().run_at.tzinfo is not None
    with pytest.raises(ValueError):
        PipelineConfig.now(gold_mode="other")


def test_a_missing_silver_folder_fails(spark, lake, tmp_path):
    cfg = config({**lake, "silver_path": str(tmp_path / "mistyped")})
    with pytest.raises(AnalysisException):
        jobs.run_gold(spark, cfg)
    assert not os.path.exists(lake["gold_path"])


def test_replacement_drops_days_that_silver_lost(spark, lake, tmp_path):
    two_days = [*HOURS, measured("2024-01-30T05:00:00-03:00", 50.0)]
    payload(lake, station(820321, "x", (1, two_days)))
    run_all(spark, config(lake))
    assert {r.anomesdia for r in gold(spark, lake).collect()} == {20240129, 20240130}
    again = {**lake, "silver_path": str(tmp_path / "silver-2")}
    silver(spark, lake).where("anomesdia = 20240130").write.partitionBy("anomesdia").parquet(
        again["silver_path"]
    )
    # a window that does not reach the lost day leaves it alone
    jobs.run_gold(spark, config(again, gold_mode="replace_days", gold_days=1))
    assert {r.anomesdia for r in gold(spark, lake).collect()} == {20240129, 20240130}
    jobs.run_gold(spark, config(again, gold_mode="replace_days", gold_days=3))
    assert {r.anomesdia for r in gold(spark, lake).collect()} == {20240130}


def test_a_catalog_table_is_replaced_by_window(spark, lake, monkeypatch):
    payload(lake, station(820321, "x", (1, HOURS)))
    run_all(spark, config(lake))
    given = []
    monkeypatch.setattr(
        jobs, "replace_catalog_window", lambda df, table, start: given.append((df, table, start))
    )
    for days in (3, 0):
        cfg = config(lake, gold_mode="replace_days", gold_table="c.gold", gold_days=days)
        jobs.run_gold(spark, cfg)
    assert [(table, start) for _, table, start in given] == [("c.gold", 20240128), ("c.gold", None)]
    assert Counter(given[0][0].collect()) == Counter(gold(spark, lake).collect())


def test_a_rerun_without_rejected_rows_empties_its_quarantine(spark, lake):
    aside = {"quarantine_path": lake["quarantine_path"]}
    payload(lake, station(820321, "x", (1, [*HOURS, TIMELESS])))
    run_all(spark, config(lake, **aside))
    folder = f"{lake['quarantine_path']}/silver/run_date=2024-01-30"
    assert os.path.exists(folder)
    payload(lake, station(820321, "x", (1, HOURS)))
    run_all(spark, config(lake, **aside))
    assert not os.path.exists(folder)


def test_landing_takes_the_listed_stations_and_counts_what_it_wrote(spark, lake):
    payload(lake, station(1, "a", (1, HOURS)), station(2, "b", (2, HOURS)))
    counts = jobs.run_landing(spark, config(lake, location_ids=(2, 3)))
    payload(lake, station(3, "c", (3, HOURS[:1])))
    # what the payload says after the run does not matter
    assert {r.location_id: r.n_rows for r in counts.collect()} == {2: 5}
    assert jobs.run_landing(spark, config(lake, 31, location_ids=(9,))).count() == 0


def test_silver_reads_the_registered_bronze_table(spark, lake, view):
    payload(lake, station(820321, "x", (1, HOURS)))
    spark.sql(
        f"CREATE TABLE {view} ({BRONZE}) USING parquet "
        f"PARTITIONED BY (data_ingestao, tipo_ingestao) LOCATION '{lake['bronze_path']}'"
    )
    cfg = config(lake, bronze_table=view)
    jobs.run_landing(spark, cfg)
    jobs.run_bronze_daily(spark, config(lake))  # written, but not registered
    jobs.run_silver(spark, cfg)
    assert silver(spark, lake).count() == 0
    jobs.run_bronze_daily(spark, cfg)
    jobs.run_silver(spark, cfg)
    assert silver(spark, lake).count() == 5
    spark.sql(f"DROP TABLE {view}")


def test_landing_is_checked_as_it_is_written(spark, lake, monkeypatch):
    none = {"period": None, "parameter": None, "value": 1.0}
    payload(
        lake,
        station(820321, "x", (1, HOURS), (None, HOURS[:2])),
        station(820321, "another name", (3, [none])),
        station(77, "unlisted", (7, HOURS[:2])),
        station(None, "nowhere", (8, HOURS[:1])),
    )
    monkeypatch.setattr(jobs, "read_landing", None)  # nothing is read again
    counts, seen = jobs.land(spark, config(lake))
    assert {r.location_id: r.n_rows for r in counts.collect()} == {820321: 8, 77: 2, None: 1}
    assert seen == {"n_rows": 11, "n_null_keys": 3, "n_no_station": 1, "n_unlisted": 2, "n_two_names": 1}


def test_more_stations_than_the_check_tells_apart(spark, lake, monkeypatch):
    monkeypatch.setattr(checks, "STATIONS_AT_MOST", 3)
    payload(lake, *[station(i, "x", (i, HOURS[: i + 1])) for i in range(5)])
    counts = {r.location_id: r.n_rows for r in jobs.run_landing(spark, config(lake)).collect()}
    assert counts == {i: min(i + 1, 5) for i in range(5)}


def test_late_readings_reach_gold_by_changed_days(spark, lake, tmp_path):
    ledger = {"ledger_path": str(tmp_path / "ledger"), "gold_mode": "changed_days", "gold_days": 1}
    days = [measured(f"2024-01-{d}T05:00:00-03:00", float(d)) for d in range(27, 31)]
    payload(lake, station(820321, "x", (1, days)))
    run_all(spark, config(lake, 30, **ledger))
    written = {r.anomesdia: r.f for r in gold_files(spark, lake)}
    assert sorted(written) == [20240127, 20240128, 20240129, 20240130]
    # a reading three days back, out of gold's window
    payload(lake, station(820321, "x", (1, [measured("2024-01-28T22:00:00-03:00", 99.0)])))
    run_all(spark, config(lake, 31, **ledger))
    tops = {r.anomesdia: r.top1_valor for r in gold(spark, lake).collect()}
    assert tops == {20240127: 27.0, 20240128: 99.0, 20240129: 29.0, 20240130: 30.0}
    again = {r.anomesdia: r.f for r in gold_files(spark, lake)}
    assert [d for d in again if again[d] != written[d]] == [20240128]
    jobs.run_gold(spark, config(lake, 31, **ledger))  # nothing has changed
    assert {r.anomesdia: r.f for r in gold_files(spark, lake)} == again
    with pytest.raises(ValueError):
        config(lake, gold_mode="changed_days")


def gold_files(spark, lake):
    rows = gold(spark, lake).selectExpr("anomesdia", "input_file_name() AS f")
    return rows.distinct().collect()


def test_history_is_loaded_once(spark, lake, tmp_path):
    os.makedirs(lake["history_path"])
    header = "location_id,sensors_id,location,datetime,lat,lon,parameter,units,value\n"
    row = "1,{},x,2024-01-29T00:00:00Z,1.5,2.5,p,u,3.5\n"
    files = {n: header + row.format(n) for n in "123"}
    cfg = config(lake, ledger_path=str(tmp_path / "ledger"))

    def load(*names):
        for n in names:
            with open(f"{lake['history_path']}/{n}.csv", "w") as out:
                out.write(files[n[0]])
        jobs.run_bronze_history(spark, cfg)
        bronze = read_bronze_window(spark, lake["bronze_path"], date(2024, 1, 30), 0)
        return sorted(r.sensors_id for r in bronze.collect())

    assert load("1", "2") == [1, 2] == load()
    assert load("1 copy", "3") == [1, 2, 3] == load("2 copy")


@pytest.mark.parametrize("at_a_time", [2, 100])
def test_incremental_runs_equal_the_jobs(spark, lake, tmp_path, at_a_time):
    def landed(day, value, station=820321):
        at = datetime(2024, 1, day, tzinfo=ZONE)
        rows = [(station, station, "x", at.replace(hour=h), 1.0, 2.0, "p", "u", value) for h in range(3)]
        rows.append((station + 1, 9, "y", datetime(2024, 1, 27, tzinfo=ZONE), 1.0, 2.0, "p", "u", value))
        write_landing(spark.createDataFrame(rows, LANDING), lake["landing_path"], date(2024, 1, day))

    died = []

    def dies_once(spark, cfg, day, *more):
        if day == date(2024, 1, 29) and not died:
            died.append(jobs.run_bronze_daily(spark, replace(cfg, run_at=datetime(2024, 1, 29, 12))))
            raise RuntimeError("killed between bronze and silver")
        incremental.bring_day(spark, cfg, day, *more)

    checkpoint = str(tmp_path / "checkpoint")
    for days in ([28, 29], [30], [29, 31]):  # the second time, files come late for the 29th
        for day in days:
            landed(day, float(day), 820321 if days != [29, 31] else 55)
        try:
            incremental.run_incremental(spark, config(lake), checkpoint, at_a_time=at_a_time, bring=dies_once)
        except StreamingQueryException:
            incremental.run_incremental(spark, config(lake), checkpoint, at_a_time=at_a_time)
    assert died
    batch = {**lake, "bronze_path": str(tmp_path / "b"), "silver_path": str(tmp_path / "s")}
    for day in (28, 29, 30, 31):
        jobs.run_bronze_daily(spark, config(batch, day))
        jobs.run_silver(spark, config(batch, day, silver_days=1))
    ours, theirs = silver(spark, lake).collect(), silver(spark, batch).collect()
    assert Counter(ours) == Counter(theirs) and len(ours) > 10

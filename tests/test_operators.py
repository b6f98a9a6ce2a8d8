"""Edge rows of every operator."""

import math
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stationlake import operators as op
from stationlake.operators import extremes, ranking
from stationlake.functions import day_key
from stationlake.schemas import BRONZE_COLUMNS, PAYLOAD, SILVER_COLUMNS
from stationlake.sources.dims import PARAMETERS, STATIONS, station_dim

NAN = float("nan")


def rows(df, *cols):
    return Counter(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_day_key_is_a_day_in_the_session_zone(spark):
    df = spark.createDataFrame(
        [("2026-10-01T01:00:00Z",), ("2026-09-30T23:30:00-03:00",), (None,)], "t STRING"
    )
    got = [r[0] for r in df.select(day_key(F.col("t").cast("timestamp"))).collect()]
    assert got == [20260930, 20260930, None]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_day_key_is_the_formatted_day(spark, kind):
    # every 7 hours from 1899 to 2101, so across all offset changes of the zone
    df = spark.range(-2_240_000_000, 4_120_000_000, 7 * 3600).select(
        F.timestamp_seconds("id").cast(kind).alias("t")
    )
    text = F.substring(F.col("t").cast("string"), 1, 10)
    formatted = F.regexp_replace(text, "-", "").cast("int")
    assert df.where(day_key("t") != formatted).count() == 0


DEDUPE = "sensors_id BIGINT, datetime TIMESTAMP, value DOUBLE, data_ingestao DATE"


def test_dedupe_keeps_the_earliest_ingestion(spark):
    t = datetime(2024, 1, 1, 5)
    df = spark.createDataFrame(
        [
            (1, t, 9.0, date(2024, 1, 2)),
            (1, t, 5.0, date(2024, 1, 1)),
            (2, None, 7.0, date(2024, 1, 1)),
            (2, None, 3.0, date(2024, 1, 1)),
        ],
        DEDUPE,
    )
    got = rows(op.dedupe_readings(df), "sensors_id", "value", "data_ingestao")
    assert got == Counter([(1, 5.0, date(2024, 1, 1)), (2, 3.0, date(2024, 1, 1))])


def test_dedupe_does_not_depend_on_the_split(spark):
    t = datetime(2024, 1, 1)
    df = spark.range(2000).select(
        (F.col("id") % 7).alias("sensors_id"),
        F.lit(t).alias("datetime"),
        F.pmod(F.hash("id"), F.lit(1000)).cast("double").alias("value"),
        F.lit(date(2024, 1, 1)).alias("data_ingestao"),
    )
    results = [rows(op.dedupe_readings(df.repartition(n))) for n in (1, 3, 8)]
    assert results[0] == results[1] == results[2]
    assert sum(results[0].values()) == 7


def test_filter_polluted_id_is_three_valued(spark):
    df = spark.createDataFrame(
        [
            (9, "a", "keep"),
            (9, "x", "drop"),
            (9, None, "drop"),
            (None, "a", "keep"),
            (None, "x", "drop"),
            (1, None, "keep"),
            (1, "x", "keep"),
        ],
        "location_id BIGINT, location STRING, expected STRING",
    )
    got = op.filter_polluted_id(df, 9, ["a", "b"])
    assert rows(got, "expected") == Counter({("keep",): 4})


def test_filter_polluted_id_defaults(spark):
    df = spark.createDataFrame(
        [(3911519, "Parque Vida Nova, Caji"), (3911519, "Toronto"), (1, "Toronto")],
        "location_id BIGINT, location STRING",
    )
    assert rows(op.filter_polluted_id(df)) == Counter(
        [(3911519, "Parque Vida Nova, Caji"), (1, "Toronto")]
    )


@pytest.mark.parametrize("as_frame", [False, True])
def test_canonical_station(spark, as_frame):
    stations = {1: "Uno", 2: "Dos", 3: "Dos"}
    df = spark.createDataFrame(
        [(1, "raw"), (2, "raw2"), (3, "raw3"), (4, "raw4"), (None, "raw5"), (1, None)],
        "location_id BIGINT, location STRING",
    )
    got = op.canonical_station(df, station_dim(spark, stations) if as_frame else stations)
    assert got.columns == df.columns
    assert rows(got) == Counter(
        [(1, "Uno"), (2, "Dos"), (3, "Dos"), (4, "raw4"), (None, "raw5"), (1, "Uno")]
    )


def test_dimension_codes_are_normalised(spark):
    dim = spark.createDataFrame(
        [("PM25", "fine"), (" pm25 ", "Fine"), ("O3", "ozone")], "code STRING, description STRING"
    )
    df = spark.createDataFrame([("pm25",), (" Pm25",), ("o3",), ("x",)], "parameter STRING")
    expected = Counter([("pm25", "Fine"), (" Pm25", "Fine"), ("o3", "ozone"), ("x", "x")])
    assert rows(op.describe_parameter(df, dim)) == expected
    as_dict = {r.code: r.description for r in dim.collect()}
    assert rows(op.describe_parameter(df, as_dict)) == expected


def test_canonical_station_with_a_repeated_id_gives_no_extra_rows(spark):
    dim = spark.createDataFrame([(1, "B"), (1, "A")], "station_id BIGINT, station_name STRING")
    df = spark.createDataFrame([(1, "raw")], "location_id BIGINT, location STRING")
    assert rows(op.canonical_station(df, dim)) == Counter([(1, "A")])


def test_every_listed_station_has_one_name(spark):
    df = spark.createDataFrame(
        [(i, raw) for i in STATIONS for raw in ("one", "two")],
        "location_id BIGINT, location STRING",
    )
    got = op.canonical_station(df).distinct().collect()
    assert {(r.location_id, r.location) for r in got} == set(STATIONS.items())
    assert len(STATIONS) == 52 and len(PARAMETERS) == 12


def test_describe_parameter(spark):
    df = spark.createDataFrame(
        [("pm25",), (" PM25 ",), ("\tpm25",), ("new",), (None,)], "parameter STRING"
    )
    assert rows(op.describe_parameter(df)) == Counter(
        [
            ("pm25", "Partículas finas"),
            (" PM25 ", "Partículas finas"),
            ("\tpm25", "\tpm25"),
            ("new", "new"),
            (None, None),
        ]
    )


def bronze(spark, *readings):
    schema = (
        "location_id BIGINT, sensors_id BIGINT, location STRING, datetime TIMESTAMP, lat DOUBLE, "
        "lon DOUBLE, parameter STRING, units STRING, value DOUBLE, tipo_ingestao STRING, "
        "data_ingestao DATE"
    )
    return spark.createDataFrame(list(readings), schema)


def test_conform_readings(spark):
    t = datetime(2024, 1, 2, 3, 4)
    df = bronze(
        spark, (820321, 5, "bangu", t, 1.0, 2.0, " PM10", "u", 3.0, "api", date(2024, 1, 3))
    )
    got = op.conform_readings(df)
    assert got.columns == SILVER_COLUMNS
    assert got.schema["anomesdia"].dataType.simpleString() == "int"
    (row,) = got.collect()
    assert (row.localizacao, row.parametro, row.parametro_descricao) == (
        "Bangu",
        " PM10",
        "Partículas grossas",
    )
    assert (row.anomesdia, row.data_ingestao, row.data_hora) == (20240102, date(2024, 1, 3), t)
    assert op.conform_readings(df, normalise=True).first().parametro == "pm10"


def test_tag_ingestion(spark):
    df = bronze(spark).drop("tipo_ingestao", "data_ingestao")
    assert op.tag_ingestion(df, "api", date(2024, 1, 3)).columns == BRONZE_COLUMNS
    one = bronze(spark, (1,) + (None,) * 10)
    tagged = op.tag_ingestion(one, "historico_csv", "2024-01-03").first()
    assert (tagged.tipo_ingestao, tagged.data_ingestao) == ("historico_csv", date(2024, 1, 3))
    today = op.tag_ingestion(one, "api").select((F.current_date() == F.col("data_ingestao")))
    assert today.first()[0]


SILVER = (
    "id_localizacao BIGINT, id_sensor BIGINT, localizacao STRING, parametro STRING, "
    "parametro_descricao STRING, unidade STRING, anomesdia INT, valor DOUBLE"
)


def silver(spark, *readings):
    """Rows of (location, sensor, name, parameter, value) on one day."""
    full = [(i, s, n, p, p, "u", 20240101, v) for i, s, n, p, v in readings]
    return spark.createDataFrame(full, SILVER)


def values(row):
    return [None if v is None else ("nan" if math.isnan(v) else v) for v in row[7:]]


def test_ranks_with_nan_and_null(spark):
    df = silver(spark, *[(1, 1, "n", "p", v) for v in (NAN, 2.0, 1.0, None)])

    def order(ranked, name):
        found = ranked.orderBy(name).select("valor").collect()
        return [None if r[0] is None else str(r[0]) for r in found]

    keys = ["id_localizacao", "id_sensor"]
    assert order(op.rank_asc(df, keys, "valor"), "rn_valor_asc") == [None, "1.0", "2.0", "nan"]
    assert order(op.rank_desc(df, keys, "valor"), "rn_valor_desc") == ["nan", "2.0", "1.0", None]


@pytest.mark.parametrize("rank,name,descending", [
    (op.rank_desc, "rn_valor_desc", True), (op.rank_asc, "rn_valor_asc", False)
])
@pytest.mark.parametrize("tie", [["tie"], []])
def test_ranks_of_hot_groups_and_values(spark, rank, name, descending, tie):
    # one key, NULL, has a third of the rows, and nine in ten values are equal
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 != 0, F.col("id") % 40).alias("k"),
        F.when(F.col("id") % 10 == 0, F.pmod(F.hash("id"), F.lit(50)).cast("double"))
        .otherwise(F.when(F.col("id") % 7 != 0, F.lit(5.0))).alias("v"),
        F.col("id").alias("tie"),
    )
    value = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    plain = df.withColumn(
        name, F.row_number().over(Window.partitionBy("k").orderBy(value, "tie")).cast("bigint")
    )
    ranked = rank(df, ["k"], "v", tie)
    assert ranked.dtypes == plain.dtypes
    if not tie:  # which of equal values comes first is left open
        ranked, plain = ranked.drop("tie"), plain.drop("tie")
    assert rows(ranked) == rows(plain)


def test_equal_rows_are_ranked_over_several_ranges(spark, monkeypatch):
    written = []
    real = ranking.materialise
    monkeypatch.setattr(ranking, "materialise", lambda df: written.append(real(df)) or written[-1])
    df = spark.range(0, 4000, 1, 4).select(F.lit(1).alias("k"), F.lit(0.0).alias("v"))
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # so few rows would share a range
    try:
        ranked = op.rank_desc(df, ["k"], "v")
    finally:
        spark.conf.unset(merging)
    (ranges,) = written
    sizes = [r["count"] for r in ranges.groupBy("part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert sorted(r.rn_valor_desc for r in ranked.collect()) == list(range(1, 4001))


TAKEN = (
    "task part at inside before last first rows key text hash value desc n top bottom k0 a.b "
    "count rn number kind day bucket keys bit bits _key _text _first _row _range _before"
).split()


@pytest.mark.parametrize(
    "operator,added",
    [
        (lambda df: op.rank_desc(df, ["id"], "v", ["a.b"]), ["rn_valor_desc"]),
        (lambda df: op.rank_asc(df, ["a.b"], "v"), ["rn_valor_asc"]),
        (lambda df: op.dedupe_readings(df, ["id", "a.b"], ["v"]), []),
        (lambda df: op.canonical_station(df, {1: "one"}, "id", "name"), []),
        (lambda df: op.canonical_station(df, df.sparkSession.sql("SELECT 9L station_id, 'x' station_name"), "id", "name"), []),
        (lambda df: op.describe_parameter(df, {"b": "B"}, "a.b"), ["parametro_descricao"]),
        (lambda df: op.merge_insert_only(df.limit(0), df, ["id", "a.b"]), []),
        (lambda df: op.replace_days(df, df, "part", []), []),
        (lambda df: op.split_valid(df, ["id", "a.b"])[0], []),
    ],
)
def test_columns_of_the_caller_stay(spark, operator, added):
    mine = [F.concat(F.lit(f"{c}-"), F.col("id")).alias(c) for c in TAKEN]
    df = spark.range(50).select("id", (F.col("id") % 7).cast("double").alias("v"), F.lit("n").alias("name"), *mine)
    got = operator(df)
    assert got.columns == [*df.columns, *added]
    rows = {r["id"]: r.asDict() for r in got.collect()}
    assert len(rows) == 50
    for r in df.collect():
        kept = {c: v for c, v in rows[r["id"]].items() if c not in added}
        assert kept | {"name": "n"} == r.asDict()


def test_extremes_take_any_names(spark):
    mine = [F.lit(c).alias(c) for c in TAKEN if c not in ("a.b", "value")]
    df = spark.range(30).select((F.col("id") % 3).alias("a.b"), F.col("id").cast("double").alias("value"), *mine)
    dims = ["a.b", "top", "desc", "n", "bottom", "value"]
    (row,) = op.daily_extremes(df.where("value = 29"), ["a.b"], dims, "value", 2).collect()
    assert row.asDict() == {
        "a.b": 2, "top": "top", "desc": "desc", "n": "n", "bottom": "bottom", "value": 29.0,
        "top1_valor": 29.0, "top2_valor": None, "bottom1_valor": 29.0, "bottom2_valor": None,
    }


@pytest.mark.parametrize("kind", ["double", "float", "decimal(10,2)", "string", "date", "int"])
def test_cut_keeps_what_counts(spark, kind):
    # one group has all but a few rows; labels and values that matter are at any place
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(batch, "500")
    value = "date_add(date'2024-01-01', cast(id as int))" if kind == "date" else "id * 7919 % 5000"
    df = spark.range(0, 5000, 1, 2).select(
        F.when(F.col("id") % 1000 != 1, F.lit(0)).alias("k"),
        F.when(F.col("id") % 2500 == 0, F.col("id").cast("string")).otherwise(F.lit("x")).alias("label"),
        F.when(F.col("id") % 13 != 0, F.expr(f"CAST({value} AS {kind})")).alias("v"),
    )
    try:
        cut = extremes.cut_extremes(df, ["k"], ["k", "label"], "v", 3)
        assert cut.count() <= 10 * 20 and cut.exceptAll(df).isEmpty()
        got = op.daily_extremes(df, ["k"], ["k", "label"], "v")
        assert rows(got) == rows(op.daily_extremes_joined(df, ["k"], "v", 3, ["k", "label"], ["k"]))
        assert got.count() == 4
    finally:
        spark.conf.unset(batch)


FORMS = [op.daily_extremes, op.daily_extremes_joined]


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize(
    "readings,expected",
    [
        ([5.0], [5.0, None, None, 5.0, None, None]),
        ([5.0, 7.0], [7.0, 5.0, None, 5.0, 7.0, None]),
        ([5.0, 7.0, 6.0], [7.0, 6.0, 5.0, 5.0, 6.0, 7.0]),
        ([5.0, 7.0, 6.0, 1.0], [7.0, 6.0, 5.0, 1.0, 5.0, 6.0]),
        ([5.0, 5.0, 5.0, 1.0], [5.0, 5.0, 5.0, 1.0, 5.0, 5.0]),
        ([5.0, None], [5.0, None, None, None, 5.0, None]),
        ([None], [None] * 6),
        ([NAN, 2.0, 1.0, 3.0], ["nan", 3.0, 2.0, 1.0, 2.0, 3.0]),
    ],
)
def test_extremes_of_one_sensor_day(spark, form, readings, expected):
    df = silver(spark, *[(1, 1, "n", "p", v) for v in readings])
    (row,) = form(df).collect()
    assert values(row) == expected


@pytest.mark.parametrize("form", FORMS)
def test_extremes_with_a_null_key_have_no_values(spark, form):
    df = silver(spark, (None, 1, "n", "p", 5.0), (1, 1, "n", "p", 6.0))
    got = {r.id_localizacao: values(r) for r in form(df).collect()}
    assert got == {None: [None] * 6, 1: [6.0, None, None, 6.0, None, None]}


def test_extremes_over_the_key_only(spark):
    df = silver(spark, (1, 1, "n", "p", 5.0), (1, 1, "n", "p", 6.0), (None, 1, "n", "p", 7.0))
    keys = ["id_localizacao", "anomesdia"]
    got = {r.id_localizacao: r.top2_valor for r in op.daily_extremes(df, keys, keys).collect()}
    assert got == {1: 5.0, None: None}


def test_two_names_under_one_id(spark):
    df = silver(
        spark,
        *[(1, 1, "a", "p", v) for v in (1.0, 2.0, 3.0)],
        *[(1, 1, "b", "p", v) for v in (4.0, 5.0, 6.0)],
    )
    assert op.daily_extremes_joined(df).count() == 128
    got = op.daily_extremes(df).collect()
    assert sorted(r.localizacao for r in got) == ["a", "b"]
    assert all(values(r) == [6.0, 5.0, 4.0, 1.0, 2.0, 3.0] for r in got)


@pytest.mark.parametrize("form", FORMS)
def test_two_spellings_give_two_rows(spark, form):
    df = silver(spark, (1, 1, "n", "PM25", 1.0), (1, 1, "n", "pm25", 2.0))
    got = form(df).collect()
    assert sorted(r.parametro for r in got) == ["PM25", "pm25"]
    assert all(values(r) == [2.0, 1.0, None, 1.0, 2.0, None] for r in got)


def test_extremes_and_dedupe_against_brute_force(spark):
    # a third of all rows in one group, the rest in many small ones, values with many ties
    n = 9000
    df = spark.range(0, n, 1, 7).select(
        F.lit(1).cast("bigint").alias("id_localizacao"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("id_sensor"),
        F.lit("n").alias("localizacao"),
        F.concat(F.lit("p"), F.col("id") % 2).alias("parametro"),
        F.lit("d").alias("parametro_descricao"),
        F.lit("u").alias("unidade"),
        F.lit(20240101).alias("anomesdia"),
        F.when(F.col("id") % 17 != 0, F.pmod(F.hash("id"), F.lit(400)) / 4).alias("valor"),
    )
    data = df.collect()
    groups, labels = {}, set()
    for r in data:
        groups.setdefault(r.id_sensor, []).append(r.valor)
        labels.add((r.id_sensor, r.parametro))
    assert len(groups[0]) >= n // 3

    def first(found):
        return tuple((found + [None] * 3)[:3])

    expected = Counter()
    for sensor, parameter in labels:
        known = sorted(v for v in groups[sensor] if v is not None)
        nulls = [None] * (len(groups[sensor]) - len(known))
        expected[(sensor, parameter, *first(known[::-1]), *first(nulls + known))] += 1
    got = rows(
        op.daily_extremes(df), "id_sensor", "parametro",
        *[f"{side}{i}_valor" for side in ("top", "bottom") for i in (1, 2, 3)],
    )
    assert got == expected

    lowest = {}
    for r in data:
        key = (r.id_sensor, r.parametro)
        best = lowest.get(key, (1, 0.0))
        lowest[key] = min(best, (0, 0.0) if r.valor is None else (0, r.valor + 1))
    kept = op.dedupe_readings(df, ["id_sensor", "parametro"], ["valor"])
    assert rows(kept, "id_sensor", "parametro", "valor") == Counter(
        (*key, None if mark == 0.0 else mark - 1) for key, (_, mark) in lowest.items()
    )


PAIR = "a INT, b INT, v STRING"


def test_merge_inserts_unmatched_rows_as_they_are(spark):
    target = spark.createDataFrame([(1, 1, "old"), (None, 3, "old")], PAIR)
    source = spark.createDataFrame(
        [("new", 1, 1), ("new", 1, 2), ("new", 1, 2), ("new", None, 3)], "V STRING, A INT, B INT"
    )
    got = op.merge_insert_only(target, source, ["a", "b"])
    assert got.columns == ["a", "b", "v"]
    assert rows(got) == Counter({(1, 2, "new"): 2, (None, 3, "new"): 1})


def test_merging_twice_inserts_nothing_new(spark):
    target = spark.createDataFrame([(1, 1, "old")], PAIR)
    source = spark.createDataFrame([(1, 1, "new"), (1, 2, "new")], PAIR)
    once = target.unionByName(op.merge_insert_only(target, source, ["a", "b"]))
    assert op.merge_insert_only(once, source, ["a", "b"]).count() == 0


def test_split_valid(spark):
    df = spark.createDataFrame([(1, 1, "x"), (None, 1, "y"), (1, None, "z")], PAIR)
    valid, rejected = op.split_valid(df, ["a", "b"])
    assert rows(valid, "v") == Counter([("x",)])
    assert rows(rejected, "v") == Counter([("y",), ("z",)])


def test_replace_days(spark):
    schema = "anomesdia INT, v STRING"
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], schema)
    source = spark.createDataFrame([(2, "new"), (2, "late"), (None, "new")], schema)
    assert rows(op.replace_days(target, source)) == Counter(
        [(1, "old"), (None, "old"), (2, "new"), (2, "late"), (None, "new")]
    )
    # a day that is asked for is emptied even if the source has nothing for it
    assert rows(op.replace_days(target, source, days=[1, 2])) == Counter(
        [(None, "old"), (2, "new"), (2, "late")]
    )


def test_days_met_lists_all_days(spark, tmp_path):
    target = spark.createDataFrame([(d,) for d in range(1, 10)], "anomesdia INT")
    batch = spark.createDataFrame([(3,), (5,), (5,), (7,), (None,)], "d INT")
    met = op.days_met(batch, F.col("d"))
    assert sorted(r.anomesdia for r in target.where(met).collect()) == [3, 5, 7]
    assert op.days_met(batch.where("d IS NULL"), F.col("d")) is None


def test_an_outlier_day_does_not_widen_what_a_merge_reads(spark, tmp_path):
    # 1,500 days and one of 1970, against a target that has days between them
    days = spark.range(1500).select(F.expr("CAST(20200000 + id AS INT)").alias("d"))
    batch = days.unionByName(spark.createDataFrame([(19700101,)], "d INT"))
    path = str(tmp_path / "target")
    stored = spark.createDataFrame(
        [(1, 20200003), (2, 20201499), (3, 20150101), (4, 19700101), (5, 20209999)],
        "v INT, anomesdia INT",
    )
    stored.write.partitionBy("anomesdia").parquet(path)
    read = spark.read.parquet(path).where(op.days_met(batch, F.col("d")))
    assert {r.v for r in read.collect()} == {1, 2, 4}
    assert len(read.inputFiles()) == 5
    (scan,) = [
        line for line in read._jdf.queryExecution().executedPlan().toString().splitlines()
        if "FileScan" in line
    ]
    assert "PartitionFilters: [" in scan and "anomesdia" in scan.split("PartitionFilters: ")[1]


@pytest.mark.parametrize("days,expected", [(3, 3), (1, 1), (0, 10), (-1, 10)])
def test_windows_count_days_back(spark, days, expected):
    run = date(2024, 3, 2)
    df = spark.range(10).select(F.date_sub(F.lit(run), F.col("id").cast("int")).alias("d"))
    assert op.ingestion_window(df, run, days, "d").count() == expected
    keyed = df.select(F.date_format("d", "yyyyMMdd").cast("int").alias("k"))
    assert op.event_day_window(keyed, run, days, "k").count() == expected


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_rolling_interval_bounds(spark, kind):
    df = spark.createDataFrame(
        [
            ("2024-01-26 23:59:59", False),
            ("2024-01-27 00:00:00", True),
            ("2024-01-30 10:00:00", True),
            ("2024-01-30 10:00:01", False),
            (None, False),
        ],
        "t STRING, inside BOOLEAN",
    ).withColumn("t", F.col("t").cast(kind))
    now = datetime(2024, 1, 30, 10, 0, 0, 999)
    assert rows(op.rolling_interval(df, now, 3, "t"), "inside") == Counter({(True,): 2})
    assert op.rolling_interval(df, now, 3, "t", keep_null=True).count() == 3


def test_flatten_payload(spark):
    m = {"period": {"datetimeTo": {"local": "T"}}, "parameter": {"name": "o3", "units": "u"}, "value": 1.0}
    bare = {"period": None, "parameter": None, "value": None}
    at = {"latitude": 1.0, "longitude": 2.0}
    df = spark.createDataFrame(
        [
            (1, "full", at, [{"id": 10, "measurements": [m]}]),
            (2, None, at, [{"id": 20, "measurements": [bare]}]),
            (3, "no place", None, [{"id": 30, "measurements": [m, m]}]),
            (4, "empty", at, []),
            (5, "missing", at, None),
            (6, "silent", at, [{"id": 60, "measurements": []}, {"id": 61, "measurements": None}]),
        ],
        PAYLOAD,
    )
    assert rows(op.flatten_payload(df)) == Counter(
        {
            (1, 10, "full", "T", 1.0, 2.0, "o3", "u", 1.0): 1,
            (2, 20, None, None, 1.0, 2.0, None, None, None): 1,
            (3, 30, "no place", "T", None, None, "o3", "u", 1.0): 2,
        }
    )


def test_landed_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "location_id BIGINT")
    assert rows(op.landed_counts(df)) == Counter([(1, 2), (2, 1)])


def test_only_met_rows_of_the_target_are_shuffled(spark):
    # a batch of 300 keys, some NULL or repeated, against a large target
    target = spark.range(0, 200_000, 1, 4).select(
        F.when(F.col("id") % 11 != 0, F.col("id")).alias("k"),
        F.concat(F.lit("t"), F.col("id") % 3).alias("a.b"),
        F.lit(1).alias("bits"),
    )
    batch = spark.range(0, 400_000, 1000).select(
        F.when(F.col("id") % 7000 != 0, F.col("id")).alias("k"),
        F.concat(F.lit("t"), F.col("id") % 3).alias("a.b"),
        F.lit(2).alias("bits"),
    )
    batch = batch.unionByName(batch.limit(20))
    keys = ["k", "a.b"]
    met = op.rows_met(target, batch, keys)
    possible = target.join(batch.dropDuplicates(keys), keys, "left_semi")
    assert possible.exceptAll(met).isEmpty() and met.exceptAll(target).isEmpty()
    assert 100 < possible.count() <= met.count() < possible.count() + 100
    plain = op.merge_insert_only(target, batch, keys)
    pruned = op.merge_insert_only(target, batch, keys, batch.select(*[f"`{k}`" for k in keys]))
    assert rows(pruned) == rows(plain) and pruned.count() > 200
    # hashes of other types, or of -0.0, would differ where the join finds keys equal
    other = batch.withColumn("k", F.col("k").cast("int"))
    assert rows(op.merge_insert_only(target, other, keys, other)) == rows(plain)
    zero = spark.sql("SELECT 0.0D AS k")
    assert op.merge_insert_only(zero, spark.sql("SELECT -0.0D AS k"), ["k"], zero).count() == 0
    none = batch.where("false")
    assert op.rows_met(target, none, keys).count() == 0
    assert op.merge_insert_only(target, none, keys, none).count() == 0


def test_names_as_of_a_time(spark):
    names = spark.sql("""
        SELECT * FROM VALUES (1L, 'old', timestamp'2024-01-01'), (1L, 'new', timestamp'2024-02-01'),
          (1L, 'also new', timestamp'2024-02-01'), (2L, 'two', timestamp'2024-01-15'),
          (NULL, 'none', timestamp'2024-01-01'), (3L, 'never', NULL) AS t(station_id, station_name, valid_from)""")
    df = spark.sql("""
        SELECT * FROM VALUES (1L, 'raw', timestamp'2023-12-31'), (1L, 'raw', timestamp'2024-01-01'),
          (1L, 'raw', timestamp'2024-01-31 23:59:59'), (1L, 'raw', timestamp'2024-03-01'), (1L, 'raw', NULL),
          (2L, NULL, timestamp'2024-01-01'), (2L, NULL, timestamp'2024-02-01'), (3L, 'raw', timestamp'2024-02-01'),
          (NULL, 'raw', timestamp'2024-02-01') AS t(location_id, location, datetime)""")
    df = df.withColumn("key", F.lit("k")).withColumn("text", F.lit("t"))
    got = op.canonical_station_as_of(df, names)
    assert got.columns == df.columns
    assert [r.location for r in got.collect()] == ["raw", "old", "old", "also new", "raw", None, "two", "raw", "raw"]


def test_drifting_payloads(spark):
    def line(sensors):
        return f'{{"id": "7", "name": "x", "coordinates": null, "more": 1, "sensors": {sensors}}}'

    def measurement(value, rest=""):
        return f'[{{"id": 5, "measurements": [{{"value": {value}, "parameter": {{"name": "p"}}{rest}}}]}}]'

    values = ["1.5", '"2.5"', '"far"', "null", "[1]", "3"]
    texts = [line(measurement(v, ', "flag": true')) for v in values]
    texts += [line("[]"), line('"none"'), "{broken", None, line('[{"id": 1}, 3, {"measurements": 4}]')]
    df = spark.createDataFrame([(t,) for t in texts], "payload string")
    got = op.flatten_drifting_payload(df)
    flag = F.try_variant_get("measurement", "$.flag", "boolean")
    rows = got.select("location_id", "sensors_id", "lat", "datetime", "parameter", "value", flag.alias("flag")).collect()
    assert [r.value for r in rows] == [1.5, 2.5, None, None, None, 3.0]
    assert {tuple(r)[:5] + (r.flag,) for r in rows} == {(7, 5, None, None, "p", True)}


def test_extremes_of_groups_that_span_batches(spark):
    # batches of 7 rows end within groups; zeros of either sign are one label
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    df = spark.range(0, 600, 1, 3).select(
        F.when(F.col("id") % 50 != 0, F.expr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 40 END")).alias("k"),
        F.concat(F.lit("l"), F.col("id") % 4).alias("label"),
        F.when(F.col("id") % 5 == 0, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("zero"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7919 % 101).cast("double")).alias("v"),
    )
    dims = ["k", "label", "zero"]
    expected = rows(op.daily_extremes_joined(df, ["k"], "v", 3, ["k", "label"], ["k"]))
    spark.conf.set(batch, "7")
    try:
        assert rows(op.daily_extremes(df, ["k"], ["k", "label"], "v")) == expected
        got = op.daily_extremes(df, ["k"], dims, "v")
        assert rows(got.drop("zero")) == expected
    finally:
        spark.conf.unset(batch)


def test_extremes_hold_no_table_of_groups(spark):
    # a hash aggregate of all labels, and its merge, held more memory than the sort of the rows
    for dims in (["k"], ["k", "label"]):
        df = spark.range(10).selectExpr("id % 3 AS k", "'x' AS label", "id / 2 AS v")
        plan = op.daily_extremes(df, ["k"], dims, "v")._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" not in plan and plan.count("Sort [") == 1

"""The registered queries in plain SQL, for an independent engine on the same tables.

Every text stands on its own: it is put together from the shared CTEs below and does not go
through the operators.
"""

from __future__ import annotations

from stationlake.plans.registry import EVENT_PARAMETERS
from stationlake.sources.dims import PARAMETERS, STATIONS

READINGS = """
readings AS (
  SELECT event_id,
         CASE WHEN event_id % 97 <> 0 THEN user_id % 50 END AS location_id,
         user_id AS sensors_id,
         'L' || CAST(user_id % 50 AS VARCHAR) AS location,
         ts AS datetime,
         -23e0 - (user_id % 50) / 1e2 AS lat,
         -46e0 - (user_id % 50) / 1e2 AS lon,
         CASE WHEN event_id % 11 = 0 THEN ' ' ELSE '' END
           || CASE WHEN event_id % 7 = 0 THEN upper(event_type) ELSE event_type END
           || CASE WHEN event_id % 11 = 0 THEN ' ' ELSE '' END AS parameter,
         'u' AS units,
         CASE WHEN event_id % 13 <> 0 THEN value END AS value,
         CASE WHEN CAST(ts AS DATE) < DATE '2024-01-08' THEN 'historico_csv' ELSE 'api' END
           AS tipo_ingestao,
         CAST(CAST(ts AS DATE) + CAST(event_id % 4 AS INTEGER) AS DATE) AS data_ingestao
  FROM events
)"""

LANDING = "location_id, sensors_id, location, datetime, lat, lon, parameter, units, value"
BRONZE = f"{LANDING}, tipo_ingestao, data_ingestao"

REPEATS = f"""
repeats AS (
  SELECT {BRONZE} FROM readings
  UNION ALL
  SELECT {LANDING}, tipo_ingestao, CAST(data_ingestao + 1 AS DATE) FROM readings
)"""

SILVER = """
silver AS (
  SELECT event_id, location_id AS id_localizacao, sensors_id AS id_sensor,
         location AS localizacao, datetime AS data_hora, lat AS latitude, lon AS longitude,
         parameter AS parametro, lower(trim(parameter)) AS parametro_descricao,
         units AS unidade, value AS valor, tipo_ingestao,
         CAST(strftime(datetime, '%Y%m%d') AS INTEGER) AS anomesdia, data_ingestao
  FROM readings
)"""

DIMS = (
    "id_localizacao, id_sensor, localizacao, parametro, parametro_descricao, unidade, anomesdia"
)


def _foreign(source: str) -> str:
    return f"""
foreign_site AS (
  SELECT * REPLACE (
    CASE WHEN location_id = 7 AND (sensors_id + day(datetime)) % 3 = 1 THEN 'abroad'
         WHEN location_id = 7 AND (sensors_id + day(datetime)) % 3 = 2 THEN NULL
         ELSE location END AS location)
  FROM {source}
),
own AS (
  SELECT * FROM foreign_site WHERE location_id <> 7 OR location IN ('L7')
)"""


def _quoted(value: str | int) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _pick(values: list) -> str:
    return f"([{', '.join(map(_quoted, values))}])[sensors_id % {len(values)} + 1]"


def _whens(lookup: dict) -> str:
    return " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in lookup.items())


_DESCRIPTION = f"CASE lower(trim(parameter)) {_whens(EVENT_PARAMETERS)} ELSE parameter END"


def _conform(source: str, code: str = "parameter") -> str:
    return f"""
  SELECT location_id AS id_localizacao, sensors_id AS id_sensor,
         coalesce(n_name, location) AS localizacao, datetime AS data_hora,
         lat AS latitude, lon AS longitude, {code} AS parametro,
         {_DESCRIPTION} AS parametro_descricao, units AS unidade, value AS valor,
         tipo_ingestao, CAST(strftime(datetime, '%Y%m%d') AS INTEGER) AS anomesdia,
         data_ingestao
  FROM {source} LEFT JOIN nation ON location_id = n_nationkey"""


def _extremes_joined(
    source: str,
    value: str = "valor",
    k: int = 3,
    dims: str = DIMS,
    keys: tuple[str, ...] = ("id_localizacao", "id_sensor", "anomesdia"),
    rank_keys: str = "id_localizacao, id_sensor, localizacao, anomesdia",
) -> str:
    """One left join per rank, NULL order spelled out."""
    picks = [
        (f"{side}{i}", rank, i)
        for side, rank in (("top", "rn_desc"), ("bottom", "rn_asc"))
        for i in range(1, k + 1)
    ]
    values = ", ".join(f"{name}.{value} AS {name}_valor" for name, _, _ in picks)
    joins = "\n".join(
        f"  LEFT JOIN (SELECT * FROM ranked WHERE {rank} = {i}) {name} ON "
        + " AND ".join(f"dims.{key} = {name}.{key}" for key in keys)
        for name, rank, i in picks
    )
    return f"""
ranked AS (
  SELECT *,
         row_number() OVER (PARTITION BY {rank_keys} ORDER BY {value} DESC NULLS LAST) rn_desc,
         row_number() OVER (PARTITION BY {rank_keys} ORDER BY {value} ASC NULLS FIRST) rn_asc
  FROM {source}
),
dims AS (SELECT DISTINCT {dims} FROM {source}),
extremes AS (
  SELECT dims.*, {values}
  FROM dims
{joins}
)"""


_SHIPMENTS = """
shipments AS (
  SELECT *, CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS ship_month FROM lineitem
)"""

_DEDUPED = """
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY sensors_id, datetime
      ORDER BY data_ingestao NULLS FIRST, location_id NULLS FIRST, location NULLS FIRST,
               lat NULLS FIRST, lon NULLS FIRST, parameter NULLS FIRST, units NULLS FIRST,
               value NULLS FIRST, tipo_ingestao NULLS FIRST) AS rn
    FROM {source})
  WHERE rn = 1
)"""

_MERGE_SIDES = """
timeless AS (
  SELECT * REPLACE (CASE WHEN sensors_id % 23 <> 0 THEN datetime END AS datetime) FROM repeats
),
all_rows AS (
  SELECT location_id AS id_localizacao, sensors_id AS id_sensor, location AS localizacao,
         datetime AS data_hora, lat AS latitude, lon AS longitude, parameter AS parametro,
         parameter AS parametro_descricao, units AS unidade, value AS valor, tipo_ingestao,
         CAST(strftime(datetime, '%Y%m%d') AS INTEGER) AS anomesdia, data_ingestao
  FROM timeless
),
target AS (SELECT * FROM all_rows WHERE data_ingestao <= DATE '2024-01-15'),
source AS (
  SELECT * REPLACE (valor + 1e0 AS valor) FROM all_rows
  WHERE data_ingestao >= DATE '2024-01-12'
)"""


def _merged(target: str, source: str, keys: tuple[str, ...]) -> str:
    same = " AND ".join(f"t.{key} = s.{key}" for key in keys)
    return f"""
SELECT * FROM {target}
UNION ALL
SELECT * FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {same})"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_SILVER_COLUMNS = """location_id AS id_localizacao, sensors_id AS id_sensor,
       location AS localizacao, datetime AS data_hora, lat AS latitude, lon AS longitude,
       parameter AS parametro, parameter AS parametro_descricao, units AS unidade,
       value AS valor, tipo_ingestao, CAST(strftime(datetime, '%Y%m%d') AS INTEGER) AS anomesdia"""

_SILVER_TWICE = _with(READINGS) + """
SELECT location_id AS id_localizacao, sensors_id AS id_sensor, location AS localizacao,
       datetime AS data_hora, lat AS latitude, lon AS longitude, parameter AS parametro,
       parameter AS parametro_descricao, units AS unidade,
       CASE WHEN data_ingestao <= DATE '2024-01-15' THEN value ELSE value + 1e0 END AS valor,
       tipo_ingestao, CAST(strftime(datetime, '%Y%m%d') AS INTEGER) AS anomesdia, data_ingestao
FROM readings WHERE location_id <> 7 OR location IN ('L7')"""


def _rank(direction: str, name: str) -> str:
    return (
        _with(READINGS, SILVER)
        + f"""
SELECT id_localizacao, id_sensor, localizacao, anomesdia, event_id, valor,
       row_number() OVER (PARTITION BY id_localizacao, id_sensor, localizacao, anomesdia
                          ORDER BY valor {direction}, event_id) AS {name}
FROM silver"""
    )


_GOLD = " SELECT * FROM extremes"
_SHIPMENT_KEYS = ("l_suppkey", "l_returnflag", "ship_month")
_SHIPMENT_LIST = ", ".join(_SHIPMENT_KEYS)


_FLAT = """
WITH rows AS (
  SELECT event_id, user_id, ts, event_type, value, 2 * user_id AS sensors_id,
         value AS v, event_type AS code FROM events
  UNION ALL
  SELECT event_id, user_id, ts, event_type, value, 2 * user_id, value + 1e0, upper(event_type)
  FROM events
  UNION ALL
  SELECT event_id, user_id, ts, event_type, value, 2 * user_id + 1, -value, lower(event_type)
  FROM events WHERE event_id % 3 <> 0
)"""
_FLAT_COLUMNS = """event_id AS location_id, sensors_id, 'L' || CAST(event_id AS VARCHAR) AS location,
       CASE WHEN event_id % 13 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS datetime,
       CASE WHEN event_id % 5 <> 0 THEN user_id / 4e0 END AS lat,
       CASE WHEN event_id % 5 <> 0 THEN -user_id / 4e0 END AS lon,
       CASE WHEN event_id % 17 <> 0 THEN code END AS parameter,
       CASE WHEN event_id % 17 <> 0 THEN 'u' END AS units,
       v AS value"""
_STATIONS = _FLAT_COLUMNS.replace("event_id AS location_id", "event_id % 50 AS location_id", 1)
_RECENT = """event_id % 19 <> 0 AND event_id % 50 < 30
  AND (event_id % 13 = 0 OR date_trunc('second', ts)
       BETWEEN TIMESTAMP '2024-01-27 00:00:00' AND TIMESTAMP '2024-01-30 10:00:00')"""


def oracle_sql() -> dict[str, str]:
    """SQL text by query name."""
    gold_sides = f"""
early AS (SELECT * FROM extremes WHERE anomesdia <= 20240115),
late AS (SELECT * FROM extremes WHERE anomesdia >= 20240114)"""
    return {
        "daily_extremes": _with(READINGS, SILVER, _extremes_joined("silver")) + _GOLD,
        "daily_extremes_joined": _with(READINGS, SILVER, _extremes_joined("silver")) + _GOLD,
        "daily_extremes_lineitem": _with(
            _SHIPMENTS,
            _extremes_joined(
                "shipments",
                "l_extendedprice",
                dims=_SHIPMENT_LIST,
                keys=_SHIPMENT_KEYS,
                rank_keys=_SHIPMENT_LIST,
            ),
        )
        + _GOLD,
        "daily_extremes_lineitem_status": _with(
            _SHIPMENTS,
            _extremes_joined(
                "shipments",
                "l_extendedprice",
                dims=_SHIPMENT_LIST + ", l_linestatus",
                keys=_SHIPMENT_KEYS,
                rank_keys=_SHIPMENT_LIST,
            ),
        )
        + _GOLD,
        "daily_extremes_one_day": _with(
            READINGS,
            SILVER,
            "\none_day AS (SELECT * FROM silver WHERE anomesdia = 20240115)",
            _extremes_joined("one_day"),
        )
        + _GOLD,
        "daily_extremes_window": _with(
            READINGS,
            SILVER,
            "\nrecent AS (SELECT * FROM silver WHERE anomesdia >= 20240128)",
            _extremes_joined("recent"),
        )
        + _GOLD,
        "daily_extremes_top5": _with(READINGS, SILVER, _extremes_joined("silver", k=5)) + _GOLD,
        "rank_desc": _rank("DESC NULLS LAST", "rn_valor_desc"),
        "rank_asc": _rank("ASC NULLS FIRST", "rn_valor_asc"),
        "rank_desc_by_station": _with(READINGS, SILVER)
        + """
SELECT localizacao, event_id, valor,
       row_number() OVER (PARTITION BY localizacao ORDER BY valor DESC NULLS LAST, event_id)
         AS rn_valor_desc
FROM silver""",
        "rank_desc_hot_value": _with(READINGS, SILVER)
        + """
, hot AS (
  SELECT CASE WHEN event_id % 3 <> 0 THEN id_sensor END AS id_sensor, event_id,
         CASE WHEN event_id % 10 = 0 THEN valor ELSE 0e0 END AS valor
  FROM silver)
SELECT *, row_number() OVER (PARTITION BY id_sensor ORDER BY valor DESC NULLS LAST, event_id)
         AS rn_valor_desc
FROM hot""",
        "describe_parameter_dim": _with(READINGS)
        + """
SELECT event_id, parameter,
       CASE WHEN lower(trim(parameter)) = 'view' THEN parameter
            ELSE 'About ' || lower(trim(parameter)) END AS parametro_descricao
FROM readings""",
        "silver_window": _with(READINGS, SILVER)
        + " SELECT * EXCLUDE (event_id) FROM silver WHERE anomesdia >= 20240128",
        "bronze_window_table": _with(READINGS)
        + """
SELECT location_id AS id_localizacao, sensors_id AS id_sensor, location AS localizacao,
       datetime AS data_hora, lat AS latitude, lon AS longitude, parameter AS parametro,
       parameter AS parametro_descricao, units AS unidade, value AS valor, tipo_ingestao,
       CAST(strftime(datetime, '%Y%m%d') AS INTEGER) AS anomesdia, data_ingestao
FROM readings
WHERE (location_id <> 7 OR location IN ('L7'))
  AND data_ingestao BETWEEN DATE '2024-01-28' AND DATE '2024-01-30'""",
        "jobs_history": _with(READINGS)
        + f"""
SELECT {LANDING}, kind AS tipo_ingestao, DATE '2024-01-30' AS data_ingestao
FROM readings, (VALUES ('api'), ('historico_csv')) kinds(kind)""",
        "jobs_gold_replace_days": _with(
            READINGS,
            SILVER,
            """
replaced AS (
  SELECT * REPLACE (CASE WHEN anomesdia = 20240130 THEN valor + 1e0 ELSE valor END AS valor)
  FROM silver WHERE anomesdia <> 20240129
)""",
            _extremes_joined("replaced"),
        )
        + _GOLD,
        "daily_sensor_dims": _with(READINGS, SILVER) + f" SELECT DISTINCT {DIMS} FROM silver",
        "canonical_station": _with(READINGS)
        + """
SELECT event_id, location_id, coalesce(n_name, location) AS location
FROM readings LEFT JOIN nation ON location_id = n_nationkey""",
        "canonical_station_as_of": _with(
            READINGS,
            """
names AS (
  SELECT n_nationkey AS station_id, n_name || ' ' || number AS station_name,
         make_timestamp(2024, 1, 8 * number, 6, 0, 0) AS valid_from
  FROM nation, (VALUES (1), (2), (3)) numbers(number) WHERE number <= 2 + n_nationkey % 2
)""",
        )
        + """
SELECT event_id, location_id, coalesce(station_name, location) AS location
FROM readings ASOF LEFT JOIN names
  ON location_id = station_id AND datetime >= valid_from""",
        "describe_parameter": _with(READINGS)
        + f" SELECT event_id, parameter, {_DESCRIPTION} AS parametro_descricao FROM readings",
        "filter_polluted_id": _with(READINGS, _foreign("readings"))
        + " SELECT event_id, location_id, location FROM own",
        "day_key": """
SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS anomesdia FROM events""",
        "day_key_lineitem": """
SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS anomesdia, count(*) AS n_rows
FROM lineitem GROUP BY 1""",
        "conform_readings": _with(READINGS, _foreign("readings")) + _conform("own"),
        "conform_readings_normalised": _with(READINGS)
        + _conform("readings", "lower(trim(parameter))"),
        "dedupe_readings": _with(READINGS, REPEATS, _DEDUPED.format(source="repeats"))
        + " SELECT * FROM deduped",
        "dedupe_lineitem": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
             l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
             l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS rn
  FROM lineitem)
WHERE rn = 1""",
        "ingestion_window": _with(READINGS)
        + " SELECT * FROM readings WHERE data_ingestao >= DATE '2024-01-28'",
        "event_day_window": _with(READINGS, SILVER)
        + " SELECT * FROM silver WHERE anomesdia >= 20240128",
        "rolling_interval": _with(READINGS)
        + """
SELECT * FROM readings
WHERE datetime BETWEEN TIMESTAMP '2024-01-27 00:00:00' AND TIMESTAMP '2024-01-30 10:00:00'""",
        "merge_insert_only": _with(READINGS, REPEATS, _MERGE_SIDES)
        + _merged("target", "source", ("anomesdia", "id_sensor", "data_hora")),
        "merge_insert_only_pruned": _with(READINGS, REPEATS, _MERGE_SIDES)
        + """
SELECT * FROM all_rows b
WHERE data_ingestao >= DATE '2024-01-28' AND NOT EXISTS (
  SELECT 1 FROM all_rows t
  WHERE t.id_sensor % 5 <> 0 AND t.id_sensor = b.id_sensor AND t.data_hora = b.data_hora)""",
        "merge_insert_only_gold": _with(READINGS, SILVER, _extremes_joined("silver"), gold_sides)
        + _merged("early", "late", ("anomesdia", "id_localizacao", "id_sensor")),
        "split_valid": _with(READINGS, REPEATS, _MERGE_SIDES)
        + """
SELECT id_localizacao, id_sensor, data_hora, valor, data_ingestao,
       anomesdia IS NOT NULL AND id_sensor IS NOT NULL AND data_hora IS NOT NULL AS valid
FROM all_rows""",
        "replace_days": _with(READINGS, SILVER)
        + """
SELECT * FROM silver WHERE anomesdia NOT BETWEEN 20240110 AND 20240112
UNION ALL
SELECT * REPLACE (valor + 1e0 AS valor) FROM silver
WHERE anomesdia BETWEEN 20240110 AND 20240112""",
        "silver_batch": _with(
            READINGS, REPEATS, _foreign("repeats"), _DEDUPED.format(source="own")
        )
        + _conform("deduped"),
        "gold_from_silver": _with(
            READINGS,
            REPEATS,
            _foreign("repeats"),
            _DEDUPED.format(source="own"),
            f"\nconformed AS ({_conform('deduped')})",
            _extremes_joined("conformed"),
        )
        + _GOLD,
        "tag_ingestion": _with(READINGS)
        + f"""
SELECT {LANDING}, 'historico_csv' AS tipo_ingestao, DATE '2024-01-30' AS data_ingestao
FROM readings""",
        "landed_counts": _with(READINGS)
        + " SELECT location_id, count(*) AS n_rows FROM readings GROUP BY location_id",
        "flatten_payload": f"{_FLAT} SELECT {_FLAT_COLUMNS} FROM rows WHERE event_id % 19 <> 0",
        "flatten_drifting_payload": f"""{_FLAT}
SELECT {_FLAT_COLUMNS}, event_id % 5 = 0 AND value IS NOT NULL AS flag
FROM rows WHERE event_id % 19 <> 0""",
        "jobs_landing_counts": f"""{_FLAT}
SELECT location_id, count(*) AS n_rows
FROM (SELECT {_STATIONS} FROM rows WHERE {_RECENT}) GROUP BY 1""",
        "jobs_landing_to_bronze": f"""{_FLAT}
SELECT * REPLACE (CAST(datetime AS TIMESTAMP) AS datetime), 'api' AS tipo_ingestao,
       DATE '2024-01-30' AS data_ingestao
FROM (SELECT {_STATIONS} FROM rows WHERE {_RECENT})""",
        "landing_roundtrip": _with(READINGS) + f" SELECT {LANDING} FROM readings",
        "history_csv_roundtrip": _with(READINGS)
        + f"""
SELECT {LANDING}, 'historico_csv' AS tipo_ingestao, DATE '2024-01-30' AS data_ingestao
FROM readings""",
        "bronze_rerun_idempotent": _with(READINGS)
        + f"""
SELECT {LANDING}, 'api' AS tipo_ingestao, d AS data_ingestao
FROM readings, (VALUES (DATE '2024-01-29'), (DATE '2024-01-30')) days(d)""",
        "conform_readings_listed": _with(READINGS)
        + f"""
, picked AS (
  SELECT *, {_pick([*STATIONS, 1])} AS station, upper({_pick([*PARAMETERS, "other"])}) AS code
  FROM readings)
SELECT CAST(station AS BIGINT) AS id_localizacao, sensors_id AS id_sensor,
       CASE station {_whens(STATIONS)} ELSE location END AS localizacao,
       code AS parametro, CASE lower(code) {_whens(PARAMETERS)} ELSE code END
         AS parametro_descricao, value AS valor
FROM picked""",
        "jobs_bronze_to_gold": _with(
            READINGS,
            _foreign("readings"),
            f"\nconformed AS ({_conform('own')})",
            _extremes_joined("conformed"),
        )
        + _GOLD,
        "jobs_silver_twice": _SILVER_TWICE,
        "jobs_silver_bucketed": _SILVER_TWICE,
        "tag_ingestion_today": _with(READINGS)
        + f" SELECT {LANDING}, 'api' AS tipo_ingestao, 0 AS age FROM readings",
        "daily_extremes_sql": _with(
            READINGS,
            SILVER,
            "late AS (SELECT * FROM silver WHERE anomesdia >= 20240128)",
            _extremes_joined("late"),
        )
        + _GOLD,
        "jobs_changed_days": _with(
            READINGS,
            SILVER,
            """
own AS (
  SELECT * REPLACE (parametro AS parametro_descricao)
  FROM silver WHERE id_localizacao <> 7 OR localizacao IN ('L7')
)""",
            _extremes_joined("own"),
        )
        + _GOLD,
        "jobs_incremental": _with(READINGS)
        + f"""
SELECT * REPLACE ('api' AS tipo_ingestao) FROM (SELECT {_SILVER_COLUMNS}, data_ingestao
FROM readings
WHERE data_ingestao BETWEEN DATE '2024-01-10' AND DATE '2024-01-14'
  AND (location_id <> 7 OR location IN ('L7')))""",
        "jobs_rejected": """
SELECT 'api' AS kind, count(*) FILTER (event_id % 10 <> 0) AS n, true AS good FROM events
UNION ALL
SELECT 'api', count(*) FILTER (event_id % 10 = 0), false FROM events
UNION ALL
SELECT 'historico_csv', count(*) FILTER (event_id % 15 <> 0), true FROM events
UNION ALL
SELECT 'historico_csv', count(*) FILTER (event_id % 15 = 0), false FROM events""",
        "bronze_window": _with(READINGS)
        + f" SELECT {BRONZE} FROM readings WHERE data_ingestao >= DATE '2024-01-28'",
    }

"""Declared schemas. Inference is never used: types would drift from day to day."""

from __future__ import annotations

# nine columns shared by landed NDJSON and the history CSV
LANDING = """
    location_id BIGINT, sensors_id BIGINT, location STRING, datetime TIMESTAMP,
    lat DOUBLE, lon DOUBLE, parameter STRING, units STRING, value DOUBLE
"""

# same, for sources whose timestamps carry no zone
LANDING_NTZ = LANDING.replace("datetime TIMESTAMP", "datetime TIMESTAMP_NTZ")

LANDING_COLUMNS = [
    "location_id", "sensors_id", "location", "datetime",
    "lat", "lon", "parameter", "units", "value",
]

BRONZE = LANDING + ", tipo_ingestao STRING, data_ingestao DATE"
BRONZE_COLUMNS = [*LANDING_COLUMNS, "tipo_ingestao", "data_ingestao"]

SILVER = """
    id_localizacao BIGINT, id_sensor BIGINT, localizacao STRING, data_hora TIMESTAMP,
    latitude DOUBLE, longitude DOUBLE, parametro STRING, parametro_descricao STRING,
    unidade STRING, valor DOUBLE, tipo_ingestao STRING, anomesdia INT, data_ingestao DATE
"""
SILVER_COLUMNS = [
    "id_localizacao", "id_sensor", "localizacao", "data_hora", "latitude", "longitude",
    "parametro", "parametro_descricao", "unidade", "valor", "tipo_ingestao", "anomesdia",
    "data_ingestao",
]

# one row per station payload, sensors and their measurements nested
PAYLOAD = """
    id BIGINT, name STRING,
    coordinates STRUCT<latitude: DOUBLE, longitude: DOUBLE>,
    sensors ARRAY<STRUCT<
        id: BIGINT,
        measurements: ARRAY<STRUCT<
            period: STRUCT<datetimeTo: STRUCT<local: STRING>>,
            parameter: STRUCT<name: STRING, units: STRING>,
            value: DOUBLE>>>>
"""

# The day key follows from data_hora, so it is no part of a reading's identity. Left out, the
# merge keeps the partitioning of the dedupe before it.
READING_KEYS = ["id_sensor", "data_hora"]
# the most selective column first: it decides most comparisons of a sort
GOLD_KEYS = ["id_sensor", "anomesdia", "id_localizacao"]
GOLD_DIMS = [
    "id_localizacao", "id_sensor", "localizacao", "parametro", "parametro_descricao",
    "unidade", "anomesdia",
]


def gold_schema(k: int = 3) -> str:
    """Gold columns for ``k`` values on either side."""
    dims = (
        "id_localizacao BIGINT, id_sensor BIGINT, localizacao STRING, parametro STRING, "
        "parametro_descricao STRING, unidade STRING, anomesdia INT"
    )
    values = [f"{side}{i}_valor DOUBLE" for side in ("top", "bottom") for i in range(1, k + 1)]
    return ", ".join([dims, *values])

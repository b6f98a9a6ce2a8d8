"""From bronze rows to silver columns: tags, filters, canonical names, descriptions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.config import POLLUTED_ID, POLLUTED_KEEP
from stationlake.functions import day_key, normalise_code, quoted, unused
from stationlake.schemas import BRONZE_COLUMNS, SILVER_COLUMNS
from stationlake.sources.dims import PARAMETERS, STATIONS, parameter_dim, station_dim

Stations = DataFrame | dict[int, str]
Parameters = DataFrame | dict[str, str]

API = "api"
HISTORY = "historico_csv"


def tag_ingestion(df: DataFrame, kind: str, run_date: date | str | None = None) -> DataFrame:
    """Add where the rows came from and on which day; the current day if none is given."""
    day = F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")
    return df.withColumns({"tipo_ingestao": F.lit(kind), "data_ingestao": day}).select(
        *BRONZE_COLUMNS
    )


def filter_polluted_id(
    df: DataFrame,
    bad_id: int = POLLUTED_ID,
    names: Sequence[str] = POLLUTED_KEEP,
    id_col: str = "location_id",
    name_col: str = "location",
) -> DataFrame:
    """Of the rows under ``bad_id`` keep only those with a listed raw name.

    A NULL id passes only with a listed name, and a NULL name under ``bad_id`` is dropped.
    """
    return df.where((F.col(id_col) != bad_id) | F.col(name_col).isin(*names))


def _lookup(
    df: DataFrame, entries: DataFrame, on: Column, kept: Column, name: str
) -> DataFrame:
    """``df`` with column ``name`` as the text of ``entries``, else ``kept``, without extra rows.

    ``entries`` have a key and a text. Spark broadcasts a dimension that is small by bytes; one
    that is not is joined by shuffle, and the readings of a station with a large part of all rows
    are split.
    """
    key, text = (unused(n, *df.columns) for n in ("key", "text"))
    joined = df.join(entries.toDF(key, text), on == F.col(key), "left")
    return joined.withColumn(name, F.coalesce(F.col(text), kept)).drop(key, text)


def _entries(dim: DataFrame, key: Column, text: str) -> DataFrame:
    """A dimension as key and text with one row per key.

    It is grouped by more than the key alone, so that a join by shuffle partitions both of its
    sides itself; adaptive execution splits the rows of a hot key only then.
    """
    found = dim.select(key.alias("key"), F.col(quoted(text)).alias("text"))
    grouped = found.groupBy("key", F.hash("key").alias("hash"))
    return grouped.agg(F.min("text").alias("text")).select("key", "text")


def canonical_station(
    df: DataFrame,
    stations: Stations = STATIONS,
    id_col: str = "location_id",
    name_col: str = "location",
) -> DataFrame:
    """Replace the raw name by the listed one; ids that are not listed keep theirs."""
    if isinstance(stations, dict):  # a list in code
        entries = F.broadcast(station_dim(df.sparkSession, stations))
    else:
        entries = _entries(stations, F.col("station_id"), "station_name")
    return _lookup(df, entries, F.col(quoted(id_col)), F.col(quoted(name_col)), name_col)


def canonical_station_as_of(
    df: DataFrame,
    names: DataFrame,
    id_col: str = "location_id",
    name_col: str = "location",
    time_col: str = "datetime",
) -> DataFrame:
    """Replace the raw name by the one that was valid at the time of the reading.

    ``names`` have ``station_id, station_name, valid_from``; a name is valid until the station's
    next one, and of names from one time the least counts. Earlier readings, and those without a
    time, keep their name.

    The names of a station are gathered into one sorted array, so the join is on the id alone and
    finds one row for each reading: nothing is paired by range. Spark broadcasts the arrays or
    splits a hot station, as in ``canonical_station``.
    """
    key, text = (unused(n, *df.columns) for n in ("key", "text"))
    dated = names.where("station_id IS NOT NULL AND valid_from IS NOT NULL").groupBy(
        F.col("station_id").alias("key"), "valid_from"
    )
    dated = dated.agg(F.min("station_name").alias("station_name"))
    grouped = dated.groupBy("key", F.hash("key").alias("hash")).agg(
        F.sort_array(F.collect_list(F.struct("valid_from", "station_name"))).alias("text")
    )
    joined = df.join(
        grouped.select("key", "text").toDF(key, text), F.col(quoted(id_col)) == F.col(key), "left"
    )
    time = F.col(quoted(time_col))
    valid = F.filter(F.col(text), lambda name: name["valid_from"] <= time)
    named = F.coalesce(F.get(valid, F.size(valid) - 1)["station_name"], F.col(quoted(name_col)))
    return joined.withColumn(name_col, named).drop(key, text)


def describe_parameter(
    df: DataFrame,
    parameters: Parameters = PARAMETERS,
    code_col: str = "parameter",
    name: str = "parametro_descricao",
) -> DataFrame:
    """Add a description by the normalised code; unknown codes stand for themselves.

    Codes of the dimension are normalised too, and of several spellings the least description
    counts.
    """
    if isinstance(parameters, dict):  # a list in code
        unique: dict[str, str] = {}
        for code, text in parameters.items():
            code = code.strip(" ").lower()
            unique[code] = min(text, unique.get(code, text))
        entries = F.broadcast(parameter_dim(df.sparkSession, unique))
    else:
        entries = _entries(parameters, normalise_code("code"), "description")
    code = F.col(quoted(code_col))
    return _lookup(df, entries, normalise_code(code), code, name)


def conform_readings(
    df: DataFrame,
    stations: Stations = STATIONS,
    parameters: Parameters = PARAMETERS,
    normalise: bool = False,
) -> DataFrame:
    """Bronze rows in silver columns.

    ``parametro`` keeps the raw spelling unless ``normalise`` is set, in which case two
    spellings of one code no longer give two gold rows.
    """
    named = describe_parameter(canonical_station(df, stations), parameters)
    code = normalise_code("parameter") if normalise else F.col("parameter")
    return named.select(
        F.col("location_id").alias("id_localizacao"),
        F.col("sensors_id").alias("id_sensor"),
        F.col("location").alias("localizacao"),
        F.col("datetime").alias("data_hora"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        code.alias("parametro"),
        "parametro_descricao",
        F.col("units").alias("unidade"),
        F.col("value").alias("valor"),
        "tipo_ingestao",
        day_key("datetime").alias("anomesdia"),
        F.col("data_ingestao").cast("date").alias("data_ingestao"),
    ).select(*SILVER_COLUMNS)

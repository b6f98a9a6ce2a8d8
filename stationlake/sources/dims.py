"""Lookup tables: canonical station names and parameter descriptions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Station id -> canonical name.
STATIONS = {
    6152580: "Abolição",
    820321: "Bangu",
    6152581: "Barra da Tijuca",
    6152582: "Caju",
    5110472: "Campinho",
    820322: "Campo Grande",
    6152583: "Campo Grande Aurassure",
    5110511: "Campo de Santana",
    5110513: "Cascadura",
    5110473: "Cascadura 2",
    3047759: "Caxias do Sul",
    820323: "Centro",
    820324: "Copacabana",
    3852932: "GUAMÁ",
    6152584: "Guaratiba",
    6152585: "Ilha do Governador",
    6404277: "Ilha do Governador",
    6102319: "Imperatriz",
    820326: "Irajá",
    6152586: "Irajá Aurassure",
    6199572: "Jacarepaguá",
    6152587: "Lagoa",
    5616694: "Lábrea Caititu",
    5636852: "MAM",
    5110514: "Madureira",
    5040030: "Manaus",
    5648811: "Parque Madureira",
    3911519: "Parque Vida Nova, Caji",
    6152588: "Pavuna",
    6152590: "Penha",
    5616182: "Porto Velho - Brux",
    5636888: "Praça XV",
    5110474: "Presidente Vargas",
    6126992: "Quality01",
    6126993: "Quality02",
    5110512: "Quintino",
    6152591: "Ramos",
    6152592: "Realengo",
    6418495: "Recreio dos Bandeirantes",
    6152593: "Recreio dos Bandeirantes",
    6152594: "Rocha",
    6152595: "Rocinha",
    6285443: "Santa Cruz 1",
    6285444: "Santa Cruz 2",
    589967: "Sao Paulo",
    6460996: "Sao Paulo",
    820328: "São Cristóvão",
    6139516: "São Paulo",
    6152598: "Tanque",
    820329: "Tijuca",
    6178275: "Tijuca Aurassure",
    3107138: "teste1",
}

# Normalised parameter code -> description.
PARAMETERS = {
    "o3": "Ozônio",
    "no": "Óxido nítrico",
    "no2": "Dióxido de nitrogênio",
    "nox": "Óxidos de nitrogênio",
    "so2": "Dióxido de enxofre",
    "co": "Monóxido de carbono",
    "pm1": "Partículas ultrafinas",
    "pm25": "Partículas finas",
    "pm10": "Partículas grossas",
    "um003": "Contagem 0.3µm",
    "temperature": "Temperatura",
    "relativehumidity": "Umidade relativa",
}


def station_dim(spark: SparkSession, stations: dict[int, str] = STATIONS) -> DataFrame:
    """``station_id, station_name``, one row per id."""
    return spark.createDataFrame(
        pa.table(
            {
                "station_id": pa.array(list(stations.keys()), pa.int64()),
                "station_name": pa.array(list(stations.values()), pa.string()),
            }
        )
    )


def parameter_dim(spark: SparkSession, parameters: dict[str, str] = PARAMETERS) -> DataFrame:
    """``code, description``, one row per normalised code."""
    return spark.createDataFrame(
        pa.table(
            {
                "code": pa.array(list(parameters.keys()), pa.string()),
                "description": pa.array(list(parameters.values()), pa.string()),
            }
        )
    )

"""The city dimension.

The city file maps a city name to the query string of its coordinates
(``{"Ubatuba": "latitude=-23.43&longitude=-45.07", ...}``).  ``read_cities``
reads any file in that shape with Spark (one JSON object, unpivoted with
``stack`` and split with ``str_to_map``); ``city_dimension`` builds the same
rows from the fixed values below without touching storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.schemas import CITIES

# The five cities and their coordinate query strings.
CITY_COORDINATES = {
    "Ubatuba": "latitude=-23.43&longitude=-45.07",
    "Guarapari": "latitude=-20.67&longitude=-40.50",
    "Porto de Galinhas": "latitude=-8.51&longitude=-35.00",
    "Balneario Camboriu": "latitude=-26.99&longitude=-48.63",
    "Cabo Frio": "latitude=-22.89&longitude=-42.03",
}


def _coords(query: str) -> tuple[float, float]:
    parts = dict(p.split("=", 1) for p in query.split("&"))
    return float(parts["latitude"]), float(parts["longitude"])


def city_coordinates() -> list[tuple[str, float, float]]:
    return [(name, *_coords(q)) for name, q in CITY_COORDINATES.items()]


def city_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(city_coordinates(), CITIES)


def write_city_file(spark: SparkSession, path: str) -> None:
    """The city file: one JSON object of name -> coordinate query string (five fixed rows)."""
    names = list(CITY_COORDINATES)
    (spark.createDataFrame([tuple(CITY_COORDINATES.values())], ", ".join(f"`{n}` string" for n in names))
     .coalesce(1).write.mode("overwrite").json(path))


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """Read a city file (one JSON object of name -> coordinate query string)."""
    raw = spark.read.option("multiLine", "true").json(path)
    names = raw.columns
    pairs = ", ".join(f"'{n.replace(chr(39), chr(39) * 2)}', `{n}`" for n in names)
    long = raw.selectExpr(f"stack({len(names)}, {pairs}) AS (local, q)")
    m = F.expr("str_to_map(q, '&', '=')")
    return long.select(
        "local",
        m["latitude"].cast("double").alias("latitude"),
        m["longitude"].cast("double").alias("longitude"),
    )

"""Weather-shaped event logs derived from the ``events`` test table.

Every event becomes one temperature reading, a precipitation reading (unless it
is a signup), a UV reading (unless it is a purchase; every 17th offset carries
a NULL UV) and one sunrise and one sunset report for its city and day.  The
event id is the log offset ``off``, so several events for the same city and
hour are successive revisions of one forecast and the highest ``off`` wins.

``city_key="city"`` maps users onto the five cities; ``city_key="user"`` keeps
one "city" per user, which widens the key space for scale runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.functions import day_start_sql, hour_floor_sql, plus_minutes_sql
from shoreline.schemas import EVENTS

# The five cities, in the order of the city file.
CITY_NAMES = ("Ubatuba", "Guarapari", "Porto de Galinhas", "Balneario Camboriu", "Cabo Frio")

# Fixed values of the derivation (minutes after midnight).
SUNRISE_BASE_MIN = 330
SUNSET_BASE_MIN = 1050


def city_sql(ci: str) -> str:
    names = ", ".join("'" + c.replace("'", "\\'") + "'" for c in CITY_NAMES)
    return f"element_at(array({names}), CAST({ci} + 1 AS INT))"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Explicit schema: no footer sampling on the driver when the plan is built.
    return spark.read.schema(EVENTS).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def base(spark: SparkSession, sf_dir: str, city_key: str = "city") -> DataFrame:
    """Events with ``off, ci, local, hora, dia, k`` plus the raw columns the tables need."""
    return base_of(events(spark, sf_dir), city_key)


def base_of(ev: DataFrame, city_key: str = "city") -> DataFrame:
    local = city_sql("user_id % 5")
    if city_key == "user":
        local = f"concat_ws('#', {local}, CAST(user_id AS STRING))"
    elif city_key != "city":
        raise ValueError(f"unknown city_key {city_key!r}")
    return ev.selectExpr(
        "event_id AS off",
        "user_id % 5 AS ci",
        f"{local} AS local",
        f"{hour_floor_sql('ts')} AS hora",
        f"{day_start_sql('ts')} AS dia",
        "TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
        "event_type",
        "value",
        "ts",  # the raw time, for range filters that reach the reader
    )


def temperature_of(b: DataFrame) -> DataFrame:
    return b.selectExpr("off", "local", "hora", "15.0D + value / 5.0D AS temperatura")


def precipitation_of(b: DataFrame) -> DataFrame:
    return b.where("event_type <> 'signup'").selectExpr("off", "local", "hora",
                                                        "CAST(k AS DOUBLE) AS pp")


UV_SQL = "CASE WHEN off % 17 = 0 THEN NULL ELSE CAST(off * 37 % 110 AS DOUBLE) / 10.0D END"


def uv_index_of(b: DataFrame) -> DataFrame:
    return b.where("event_type <> 'purchase'").selectExpr("off", "local", "hora",
                                                          f"{UV_SQL} AS uv_index")


def sun_time_sql(base_min: int) -> str:
    """Sunrise/sunset time of a base row: its day plus a city- and offset-dependent minute."""
    return plus_minutes_sql("dia", f"CAST({base_min} + ci * 5 + off % 3 AS INT)")


def sun_time(base_min: int) -> Column:
    return F.expr(sun_time_sql(base_min))


def _sun_of(b: DataFrame, base_min: int) -> DataFrame:
    return b.selectExpr("off", "local", f"{sun_time_sql(base_min)} AS hora")


def sunrise_of(b: DataFrame) -> DataFrame:
    return _sun_of(b, SUNRISE_BASE_MIN)


def sunset_of(b: DataFrame) -> DataFrame:
    return _sun_of(b, SUNSET_BASE_MIN)


DERIVE = {
    "temperature": temperature_of,
    "precipitationProbability": precipitation_of,
    "uvIndex": uv_index_of,
    "sunrise": sunrise_of,
    "sunset": sunset_of,
}


def tagged_hourly(b: DataFrame) -> DataFrame:
    """Temperature, precipitation and UV logs tagged in ONE pass over the events
    (``latest_join_tagged`` input): every event is a temperature event, a
    precipitation event unless a signup, a UV event unless a purchase."""
    return b.selectExpr(
        "local", "hora",
        "off AS _off_temperature", "15.0D + value / 5.0D AS temperatura",
        "CASE WHEN event_type <> 'signup' THEN off END AS _off_precipitation",
        "CASE WHEN event_type <> 'signup' THEN CAST(k AS DOUBLE) END AS pp",
        "CASE WHEN event_type <> 'purchase' THEN off END AS _off_uv",
        f"CASE WHEN event_type <> 'purchase' THEN {UV_SQL} END AS uv",
    )


def tagged_sun(b: DataFrame) -> DataFrame:
    """Sunrise and sunset logs tagged in one pass; both reports of an event fall on
    the event's day, which is their join key."""
    return b.selectExpr(
        "local", "CAST(dia AS DATE) AS dia",
        "off AS _off_sunrise", f"{sun_time_sql(SUNRISE_BASE_MIN)} AS sunrise",
        "off AS _off_sunset", f"{sun_time_sql(SUNSET_BASE_MIN)} AS sunset",
    )


def table(spark: SparkSession, sf_dir: str, name: str, city_key: str = "city") -> DataFrame:
    return DERIVE[name](base(spark, sf_dir, city_key))


def temperature(spark: SparkSession, sf_dir: str, city_key: str = "city") -> DataFrame:
    return table(spark, sf_dir, "temperature", city_key)


def precipitation(spark: SparkSession, sf_dir: str, city_key: str = "city") -> DataFrame:
    return table(spark, sf_dir, "precipitationProbability", city_key)


def uv_index(spark: SparkSession, sf_dir: str, city_key: str = "city") -> DataFrame:
    return table(spark, sf_dir, "uvIndex", city_key)


def sunrise(spark: SparkSession, sf_dir: str, city_key: str = "city") -> DataFrame:
    return table(spark, sf_dir, "sunrise", city_key)


def sunset(spark: SparkSession, sf_dir: str, city_key: str = "city") -> DataFrame:
    return table(spark, sf_dir, "sunset", city_key)

"""Registered queries: payload ingest, horizon filter, topic fan-out, emission
counts and the city dimension (build-plan step 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.functions import wire_time
from shoreline.operators import views
from shoreline.operators.latest import latest_per_key
from shoreline.plans.beach import BEACH_HOUR_COLS
from shoreline.plans.catalog import chain, register
from shoreline.schemas import PAYLOAD_DAILY, PAYLOAD_HOURLY, PAYLOAD_UV
from shoreline.session import shared_dir
from shoreline.sources import payloads, topics, weather
from shoreline.sources.cities import city_coordinates, read_cities, write_city_file
from shoreline.sources.topics import json_value

NOW = "2024-01-15 08:45:00"

# Shared SQL: payload position of each event = row number inside (local, run)
# ordered by (hora, off); the ingest offset is run * 168 + position.
_HOURLY_ROWS = """
hourly_rows AS (
  SELECT off, local, hora, 15 + value / 5.0 AS temperatura,
         CASE WHEN event_type <> 'signup' THEN CAST(k AS DOUBLE) END AS pp
  FROM base),
hourly_ingest AS (
  SELECT (off // 168) * 168
           + row_number() OVER (PARTITION BY local, off // 168 ORDER BY hora, off) - 1 AS off,
         local, hora, temperatura, pp
  FROM hourly_rows)
"""


def _with(extra_ctes: str, body: str) -> str:
    # Appended to the shared CTE list by ``register`` (which prefixes "WITH base...").
    return ", " + extra_ctes.strip() + "\n" + body.strip()


def _hourly_rows(spark, sf_dir) -> DataFrame:
    b = weather.base(spark, sf_dir)
    pp = F.when(F.col("event_type") != "signup", F.col("k").cast("double"))
    return b.select("off", "local", "hora",
                    (F.lit(15.0) + F.col("value") / F.lit(5.0)).alias("temperatura"),
                    pp.alias("pp"))


def _hourly_ingest(spark, sf_dir, now=None) -> DataFrame:
    return payloads.ingest_hourly(payloads.hourly_payloads(_hourly_rows(spark, sf_dir)), now)


@register("payload_hourly_ingest", _with(_HOURLY_ROWS, """
SELECT off, local, hora, temperatura, pp FROM hourly_ingest"""))
def payload_hourly_ingest(spark, sf_dir):
    return _hourly_ingest(spark, sf_dir)


@register("payload_uv_ingest", """
SELECT (off // 168) * 168
         + row_number() OVER (PARTITION BY local, off // 168 ORDER BY hora, off) - 1 AS off,
       local, hora, uv_index
FROM uv_index""")
def payload_uv_ingest(spark, sf_dir):
    return payloads.ingest_uv(payloads.uv_payloads(weather.uv_index(spark, sf_dir)))


_DAILY_SQL = f"""
SELECT (off // 168) * 168
         + row_number() OVER (PARTITION BY local, off // 168 ORDER BY dia, off) - 1 AS off,
       local,
       dia + to_minutes(CAST({weather.SUNRISE_BASE_MIN} + 5 * ci + off % 3 AS BIGINT)) AS sunrise,
       dia + to_minutes(CAST({weather.SUNSET_BASE_MIN} + 5 * ci + off % 3 AS BIGINT)) AS sunset
FROM base"""


def _daily_payloads(spark, sf_dir) -> DataFrame:
    b = weather.base(spark, sf_dir)
    return payloads.daily_payloads(
        b.select("off", "local", F.col("dia").alias("hora"),
                 weather.sun_time(weather.SUNRISE_BASE_MIN).alias("sunrise"),
                 weather.sun_time(weather.SUNSET_BASE_MIN).alias("sunset")))


@register("payload_daily_ingest", _DAILY_SQL)
def payload_daily_ingest(spark, sf_dir):
    return payloads.ingest_daily(_daily_payloads(spark, sf_dir))


def _landed(spark, payload: DataFrame, name: str, schema) -> DataFrame:
    path = shared_dir(spark, "payloads", name)
    payloads.write_payloads(payload, path)
    return payloads.read_payloads(spark, path, schema)


# Rain arrays of odd runs lack their last value, so the zip ends one slot earlier there.
@register("documents_hourly_ingest", _with(_HOURLY_ROWS, """
SELECT off, local, hora, temperatura, pp FROM (
  SELECT *, count(*) OVER (PARTITION BY local, off // 168) AS n FROM hourly_ingest)
WHERE (off // 168) % 2 = 0 OR off % 168 < n - 1"""))
def documents_hourly_ingest(spark, sf_dir):
    """Hourly ingest of landed JSON documents whose arrays differ in length."""
    payload = payloads.hourly_payloads(_hourly_rows(spark, sf_dir))
    rain = F.col("hourly.precipitation_probability")
    shorter = F.when(F.col("run") % 2 == 0, rain).otherwise(F.slice(rain, 1, F.size(rain) - 1))
    payload = payload.withColumn("hourly", F.col("hourly").withField("precipitation_probability", shorter))
    return payloads.ingest_hourly(_landed(spark, payload, "hourly", PAYLOAD_HOURLY))


LONG_RUN = 5_000


@register("documents_long_ingest", _with(_HOURLY_ROWS.split("hourly_ingest AS")[0].rstrip().rstrip(",") + f"""
, long_ingest AS (
  SELECT off // {LONG_RUN} AS run, local, hora, temperatura, pp,
         row_number() OVER (PARTITION BY local, off // {LONG_RUN} ORDER BY hora, off) - 1 AS pos
  FROM hourly_rows)""", """
SELECT local, hora, temperatura, pp, run, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY local, hora ORDER BY run DESC, pos DESC) AS rn FROM long_ingest)
WHERE rn = 1"""))
def documents_long_ingest(spark, sf_dir):
    """Landed documents of far more than one week's slots, ordered by (run, position); of
    every hour the latest value."""
    payload = payloads.hourly_payloads(_hourly_rows(spark, sf_dir), LONG_RUN)
    log = payloads.ingest_hourly(_landed(spark, payload, "long", PAYLOAD_HOURLY), order="pair")
    latest = latest_per_key(log, ["local", "hora"], ["temperatura", "pp"])
    return latest.select("local", "hora", "temperatura", "pp", "off.run", "off.pos")


@register("documents_uv_ingest", """
SELECT (off // 168) * 168
         + row_number() OVER (PARTITION BY local, off // 168 ORDER BY hora, off) - 1 AS off,
       local, hora, uv_index
FROM uv_index""")
def documents_uv_ingest(spark, sf_dir):
    payload = payloads.uv_payloads(weather.uv_index(spark, sf_dir))
    return payloads.ingest_uv(_landed(spark, payload, "uv", PAYLOAD_UV))


@register("documents_daily_ingest", _DAILY_SQL)
def documents_daily_ingest(spark, sf_dir):
    return payloads.ingest_daily(_landed(spark, _daily_payloads(spark, sf_dir), "daily", PAYLOAD_DAILY))


@register("horizon_filter", _with(_HOURLY_ROWS, f"""
SELECT off, local, hora, temperatura, pp FROM hourly_ingest
WHERE hora >= date_trunc('hour', TIMESTAMP '{NOW}')"""))
def horizon_filter(spark, sf_dir):
    return _hourly_ingest(spark, sf_dir, now=NOW)


_FANOUT_SQL = """
fanout AS (
  SELECT 'temperature' AS topic, off, local AS key,
         json_object('local', local, 'hora', strftime(hora, '%Y-%m-%dT%H:%M'),
                     'temperatura', temperatura)::VARCHAR AS value,
         off // 168 AS run
  FROM hourly_ingest
  UNION ALL
  SELECT 'precipitationProbability', off, local,
         json_object('local', local, 'hora', strftime(hora, '%Y-%m-%dT%H:%M'), 'pp', pp)::VARCHAR,
         off // 168
  FROM hourly_ingest)
"""


def _fanout(spark, sf_dir) -> DataFrame:
    rows = _hourly_ingest(spark, sf_dir).withColumn("hora", wire_time("hora"))
    fanned = payloads.split_topics(rows, {"temperature": ["hora", "temperatura"],
                                          "precipitationProbability": ["hora", "pp"]})
    value = F.when(F.col("topic") == "temperature",
                   json_value(["local", "hora", "temperatura"])).otherwise(
        json_value(["local", "hora", "pp"]))
    return fanned.select("topic", "off", F.col("local").alias("key"), value.alias("value"),
                         F.floor(F.col("off") / F.lit(payloads.RUN_SLOTS)).cast("bigint")
                         .alias("run"))


@register("topic_fanout", _with(_HOURLY_ROWS + "," + _FANOUT_SQL,
                                "SELECT topic, off, key, value FROM fanout"))
def topic_fanout(spark, sf_dir):
    return _fanout(spark, sf_dir).drop("run")


@register("emit_counts", _with(_HOURLY_ROWS + "," + _FANOUT_SQL, """
SELECT topic, key AS local, run, count(*) AS n_events FROM fanout GROUP BY topic, key, run"""))
def emit_counts(spark, sf_dir):
    return (_fanout(spark, sf_dir).groupBy("topic", F.col("key").alias("local"), "run")
            .agg(F.count(F.lit(1)).alias("n_events")))


@register("emit_counts_observed", _with(_HOURLY_ROWS + "," + _FANOUT_SQL, """
SELECT topic, key AS local, count(*) AS n_events FROM fanout GROUP BY topic, key"""))
def emit_counts_observed(spark, sf_dir):
    """What a fan-out wrote, by topic and city, as counted by the write itself."""
    path = shared_dir(spark, "topics", "counted")
    records = _fanout(spark, sf_dir).select("topic", "key", "value", "off")
    counts = topics.write_counted(records, path, ["temperature", "precipitationProbability"],
                                  [name for name, *_ in city_coordinates()])
    return spark.createDataFrame(counts, "topic string, local string, n_events long")


_COORDS = ", ".join(f"('{name}', CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))"
                    for name, lat, lon in city_coordinates())


@register("city_dimension", f"""
SELECT h.local, h.hora, h.isDay, h.boaHora, c.latitude, c.longitude
FROM beach_hour h JOIN (VALUES {_COORDS}) AS c(local, latitude, longitude) ON h.local = c.local""")
def city_dimension(spark, sf_dir):
    """Hours with their city's coordinates, as a written city file gives them."""
    path = shared_dir(spark, "cities")
    write_city_file(spark, path)
    hours = chain(spark, sf_dir).beach_hour().select("local", "hora", "isDay", "boaHora")
    return hours.join(read_cities(spark, path), "local", "inner")


@register("known_city_partial", """
SELECT local, hora, temperatura, pp, uv, isDay, boaHora FROM beach_hour
WHERE local IN (SELECT local FROM (VALUES """ + _COORDS + """) AS c(local, latitude, longitude)
                WHERE latitude < -21)""")
def known_city_partial(spark, sf_dir):
    """Membership where most rows are of cities the dimension does not know."""
    path = shared_dir(spark, "cities")
    write_city_file(spark, path)
    known = read_cities(spark, path).where("latitude < -21")
    return views.known_cities_only(chain(spark, sf_dir).beach_hour().select(*BEACH_HOUR_COLS), known)

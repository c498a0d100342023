"""Registered queries: sinks and wire formats (build-plan step 7)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.functions import parse_wire, wire_date, wire_period_end, wire_time
from shoreline.operators.periods import GROUP, as_intervalos, explode_periods, periods_of
from shoreline.plans import beach
from shoreline.plans.catalog import chain, register
from shoreline.schemas import BEACH_DAY_GROUPED_WIRE, BEACH_HOUR_FILTERED_WIRE, BEACH_HOUR_WIRE, TEMPERATURE_WIRE
from shoreline.session import shared_dir
from shoreline.sources import topics, weather


def beach_day_records(day):
    """beachDay wire records: booleans as "true"/"false" text, ``fim`` as ``HH:59``."""
    value = topics.json_value([
        "local",
        F.col("isDay").cast("string").alias("isDay"),
        wire_date("dia").alias("dia"),
        F.col("boaHora").cast("string").alias("boaHora"),
        wire_time("inicio").alias("inicio"),
        wire_period_end("fim").alias("fim"),
    ])
    return day.select(F.col("local").alias("key"), value.alias("value"))


@register("beach_day_wire", """
SELECT local AS key,
       json_object('local', local, 'isDay', CAST(isDay AS VARCHAR),
                   'dia', strftime(dia, '%Y-%m-%d'), 'boaHora', CAST(boaHora AS VARCHAR),
                   'inicio', strftime(inicio, '%Y-%m-%dT%H:%M'),
                   'fim', strftime(fim, '%Y-%m-%dT%H:59'))::VARCHAR AS value
FROM beach_day""")
def beach_day_wire(spark, sf_dir):
    return beach_day_records(chain(spark, sf_dir).beach_day())


def grouped_records(grouped):
    """beachDayGrouped wire records: ``intervalos`` is a JSON array *string* inside the JSON."""
    hours = F.transform(as_intervalos("horas"),
                        lambda s: F.struct(wire_time(s["hora"]).alias("hora")))
    value = topics.json_value([
        "local", "boaHora", "isDay", wire_date("dia").alias("dia"),
        F.to_json(hours).alias("intervalos"),
    ])
    return grouped.select(F.col("local").alias("key"), value.alias("value"))


@register("grouped_wire_json", """
SELECT local AS key,
       json_object('local', local, 'boaHora', boaHora, 'isDay', isDay,
                   'dia', strftime(dia, '%Y-%m-%d'),
                   'intervalos', to_json(list({'hora': strftime(hora, '%Y-%m-%dT%H:%M')}
                                              ORDER BY hora))::VARCHAR)::VARCHAR AS value
FROM good GROUP BY local, dia, isDay, boaHora""")
def grouped_wire_json(spark, sf_dir):
    return grouped_records(beach.beach_day_grouped(chain(spark, sf_dir).beach_hour()))


@register("topic_roundtrip", "SELECT local, hora, temperatura, pp, uv FROM filtered")
def topic_roundtrip(spark, sf_dir):
    """Write beachHourFiltered as a keyed JSON topic below the shared folder, read it back."""
    path = shared_dir(spark, "topics", "beachHourFiltered")
    rows = chain(spark, sf_dir).filtered()
    records = topics.to_records(rows, ["local", wire_time("hora").alias("hora"), "temperatura",
                                       "pp", "uv"], off=None, topic="beachHourFiltered")
    topics.write_topic(records, path)
    decoded = topics.decode(topics.read_topic(spark, path), BEACH_HOUR_FILTERED_WIRE, keep=())
    return decoded.select("local", parse_wire("hora").alias("hora"), "temperatura", "pp", "uv")


@register("topic_placement", """
SELECT local, hora, boaHora, row_number() OVER (PARTITION BY local ORDER BY hora) AS n, 1 AS n_partitions
FROM beach_hour""")
def topic_placement(spark, sf_dir):
    """Hours as a topic placed by city: every city's records are in one partition, and there
    in the order of their time."""
    path = shared_dir(spark, "topics", "beachHour")
    value = topics.json_value(["local", wire_time("hora").alias("hora"), "boaHora"])
    hours = chain(spark, sf_dir).beach_hour()
    topics.write_batch(hours.select(F.col("local").alias("key"), value.alias("value"), "hora"), path, "beachHour", 0,
                       partitions=3, order=["hora"])
    log = topics.decode(topics.read_topic(spark, path), BEACH_HOUR_WIRE, keep=("off", "partition"))
    city = Window.partitionBy("local")
    return log.select("local", parse_wire("hora").alias("hora"), "boaHora",
                      F.row_number().over(city.orderBy("off")).cast("bigint").alias("n"),
                      (F.max("partition").over(city) - F.min("partition").over(city) + 1).alias("n_partitions"))


def grouped_rows(records):
    """beachDayGrouped wire records -> group columns + ``horas``, the sorted distinct times of
    ``intervalos``.  Text that is no such array is an empty day; unreadable times are left out."""
    rows = topics.decode(records, BEACH_DAY_GROUPED_WIRE, keep=())
    times = F.from_json("intervalos", T.ArrayType(T.StructType([T.StructField("hora", T.StringType())])))
    parsed = F.transform(times, lambda s: parse_wire(s["hora"]))
    return rows.select("local", F.col("dia").try_cast("date").alias("dia"), "isDay", "boaHora",
                       F.array_sort(F.array_distinct(F.array_compact(parsed))).alias("horas"))


@register("grouped_wire_parse", "SELECT local, dia, isDay, boaHora, inicio, fim FROM beach_day")
def grouped_wire_parse(spark, sf_dir):
    """The day stage from its wire input: grouped records written as a topic, read back,
    their hour lists parsed and merged into periods."""
    path = shared_dir(spark, "topics", "beachDayGrouped")
    records = grouped_records(beach.beach_day_grouped(chain(spark, sf_dir).beach_hour()))
    topics.write_topic(records, path)
    grouped = grouped_rows(topics.read_topic(spark, path))
    return explode_periods(grouped.select(*GROUP, periods_of("horas").alias("periodos")), keep=GROUP)


@register("tolerant_numbers", """
SELECT off, local, hora, CASE WHEN off % 11 = 0 THEN 0.0 ELSE temperatura END AS temperatura
FROM temperature""")
def tolerant_numbers(spark, sf_dir):
    """A temperature topic in which some numbers are text (read as numbers) and some are
    no numbers at all (read as zero)."""
    path = shared_dir(spark, "topics", "temperatureText")
    log = weather.temperature(spark, sf_dir)
    number = F.to_json(F.struct("local", wire_time("hora").alias("hora"), "temperatura"))
    text = F.to_json(F.struct("local", wire_time("hora").alias("hora"),
                              F.when(F.col("off") % 11 == 0, "n/a")
                              .otherwise(F.col("temperatura").cast("string")).alias("temperatura")))
    value = F.when((F.col("off") % 11 == 0) | (F.col("off") % 7 == 0), text).otherwise(number)
    topics.write_topic(log.select(F.lit("temperature").alias("topic"), F.col("local").alias("key"),
                                  value.alias("value"), "off"), path)
    read = topics.decode(topics.read_topic(spark, path), TEMPERATURE_WIRE, tolerant=True)
    return read.withColumn("hora", parse_wire("hora"))


@register("topic_rejects", """
SELECT off, CASE off % 13 WHEN 0 THEN 'malformed time' WHEN 1 THEN 'missing required field'
                          WHEN 2 THEN 'not a JSON object' ELSE 'accepted' END AS outcome,
       CASE WHEN off % 13 > 3 THEN hora END AS hora
FROM temperature""")
def topic_rejects(spark, sf_dir):
    """A temperature topic with good, malformed, absent and null times and broken values:
    every record is either accepted or rejected with its reason."""
    path = shared_dir(spark, "topics", "temperatureBroken")
    log, case = weather.temperature(spark, sf_dir), F.col("off") % 13
    hora = F.when(case == 0, "2024-13-45T99:00").when(case == 3, F.lit(None)).otherwise(wire_time("hora"))
    value = (F.when(case == 1, topics.json_value(["local", "temperatura"]))
             .when(case == 2, "{broken")
             .otherwise(topics.json_value(["local", hora.alias("hora"), "temperatura"])))
    topics.write_topic(log.select(F.lit("temperature").alias("topic"), F.col("local").alias("key"),
                                  value.alias("value"), "off"), path)
    accepted, rejected = topics.split_rejected(topics.read_topic(spark, path))
    good = topics.decode(accepted, TEMPERATURE_WIRE).select(
        "off", F.lit("accepted").alias("outcome"), parse_wire("hora").alias("hora"))
    return good.unionByName(rejected.select("off", F.col("_rejected_reason").alias("outcome"),
                                            F.lit(None).cast("timestamp_ntz").alias("hora")))

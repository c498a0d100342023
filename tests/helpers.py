"""Small fixture builders for the golden tests."""

from __future__ import annotations

import datetime as dt

from shoreline import schemas

DAY = dt.date(2024, 1, 5)


def ts(hour: int, minute: int = 0, day: dt.date = DAY) -> dt.datetime:
    return dt.datetime(day.year, day.month, day.day) + dt.timedelta(hours=hour, minutes=minute)


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def hours_frame(spark, hours, local="Ubatuba", day=DAY, is_day=True, good=True):
    """Good-hour rows (local, dia, isDay, boaHora, hora) for the period tests."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("local", T.StringType()),
                           T.StructField("dia", T.DateType()),
                           T.StructField("isDay", T.BooleanType()),
                           T.StructField("boaHora", T.BooleanType()),
                           T.StructField("hora", T.TimestampNTZType())])
    return spark.createDataFrame([(local, day, is_day, good, ts(h, day=day)) for h in hours], schema)


TEMPERATURE, PRECIPITATION, UV_INDEX = schemas.TEMPERATURE, schemas.PRECIPITATION, schemas.UV_INDEX
SUNRISE, SUNSET = schemas.SUNRISE, schemas.SUNSET

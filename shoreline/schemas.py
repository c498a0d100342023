"""Explicit schemas of every dataset exchanged between stages.

Every keyed event carries ``off`` (BIGINT): the position of the event in its
log.  "Latest" always means highest ``off``, never arrival order, so results do
not depend on which micro-batch or file an event happened to land in.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS, B, L, DT = (T.StringType(), T.DoubleType(), T.TimestampNTZType(),
                      T.BooleanType(), T.LongType(), T.DateType())


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The ``events`` test table the weather logs are derived from.
EVENTS = _st(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D),
             ("props", S))

TEMPERATURE = _st(("off", L), ("local", S), ("hora", TS), ("temperatura", D))
PRECIPITATION = _st(("off", L), ("local", S), ("hora", TS), ("pp", D))
UV_INDEX = _st(("off", L), ("local", S), ("hora", TS), ("uv_index", D))
SUNRISE = _st(("off", L), ("local", S), ("hora", TS))
SUNSET = _st(("off", L), ("local", S), ("hora", TS))

SUN_HOUR = _st(("local", S), ("dia", DT), ("sunrise", TS), ("sunset", TS))
BEACH_HOUR_FILTERED = _st(("local", S), ("hora", TS), ("temperatura", D), ("pp", D), ("uv", D))
# Wire form: times travel as ``yyyy-MM-dd'T'HH:mm`` text.
BEACH_HOUR_FILTERED_WIRE = _st(("local", S), ("hora", S), ("temperatura", D), ("pp", D), ("uv", D))
BEACH_HOUR_WIRE = _st(("local", S), ("hora", S), ("boaHora", B))
TEMPERATURE_WIRE = _st(("local", S), ("hora", S), ("temperatura", D))
# ``intervalos`` is a JSON array as text.
BEACH_DAY_GROUPED_WIRE = _st(("local", S), ("boaHora", B), ("isDay", B), ("dia", S), ("intervalos", S))
BEACH_HOUR = _st(("local", S), ("hora", TS), ("temperatura", D), ("pp", D), ("uv", D),
                 ("isDay", B), ("boaHora", B))
BEACH_DAY_GROUPED = _st(("local", S), ("dia", DT), ("isDay", B), ("boaHora", B),
                        ("intervalos", T.ArrayType(_st(("hora", TS)))))
BEACH_DAY = _st(("local", S), ("dia", DT), ("isDay", B), ("boaHora", B),
                ("inicio", TS), ("fim", TS))
CITIES = _st(("local", S), ("latitude", D), ("longitude", D))

# Read models (what a reader of the served topics receives).
BEACH_DAY_VIEW = _st(("local", S), ("isDay", B), ("boaHora", B), ("dia", S),
                     ("inicio", S), ("fim", S))
BEACH_HOUR_VIEW = _st(("local", S), ("boaHora", B), ("isDay", B), ("temperatura", S),
                      ("pp", S), ("uv", S), ("hora", S))
UV_INDEX_VIEW = _st(("local", S), ("hora", S), ("uv_index", D))

# Payloads as landed from the forecast service (parallel arrays per city).
PAYLOAD_HOURLY = _st(("local", S), ("run", L), ("hourly", _st(
    ("time", T.ArrayType(S)), ("temperature_2m", T.ArrayType(D)),
    ("precipitation_probability", T.ArrayType(D)))))
PAYLOAD_UV = _st(("local", S), ("run", L), ("hourly", _st(
    ("time", T.ArrayType(S)), ("uv_index", T.ArrayType(D)))))
PAYLOAD_DAILY = _st(("local", S), ("run", L), ("daily", _st(
    ("sunrise", T.ArrayType(S)), ("sunset", T.ArrayType(S)))))

# A topic as files: one row per record, key + JSON value + explicit offset; its readers
# also get the record's time and its partition, where its writer gave one.
TOPIC_RECORD = _st(("topic", S), ("key", S), ("value", S), ("off", L))
TOPIC_LOG = T.StructType([*TOPIC_RECORD.fields, T.StructField("timestamp", TS), T.StructField("partition", T.IntegerType())])

# The versions a streaming stage stores.
SUN_VERSION = _st(("local", S), ("dia", DT), ("sunrise", TS), ("sunset", TS), ("present", B),
                  ("version", L))
FILTERED_VERSION = _st(("local", S), ("hora", TS), ("dia", DT), ("temperatura", D), ("pp", D),
                       ("uv", D), ("present", B), ("version", L))
HOUR_VERSION = _st(("local", S), ("hora", TS), ("dia", DT), ("temperatura", D), ("pp", D), ("uv", D),
                   ("isDay", B), ("boaHora", B), ("present", B), ("version", L))
DAY_VERSION = _st(("local", S), ("dia", DT), ("isDay", B), ("boaHora", B), ("inicio", TS),
                  ("fim", TS), ("version", L))

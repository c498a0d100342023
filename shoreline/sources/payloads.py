"""Forecast payloads: per-city JSON documents of parallel arrays -> keyed events.

A payload carries ``hourly.time[]`` and one array per measure (or
``daily.sunrise[]`` / ``daily.sunset[]``).  Arrays are zipped by position and the
zip stops at the shortest array (``arrays_zip`` alone would pad with NULLs, so
every array is sliced to the common length first).  Hourly weather and UV rows
earlier than the current hour are dropped (horizon filter, ``now`` is a
parameter so runs are reproducible); sun rows are not filtered.

Each payload is one producer run for one city; a later run always wins over an
earlier one and, inside a run, a later slot over an earlier one.  The events carry
that order as ``off``: ``run * RUN_SLOTS + position`` (``order="slot"``; a document of
more than ``RUN_SLOTS`` slots is an error there, since its offsets would run into the next
run's), or the struct (run, position) (``order="pair"``), which orders documents of any
length and which ``latest_per_key`` and ``latest_join`` take like a number.

``hourly_payloads`` / ``uv_payloads`` / ``daily_payloads`` rebuild payloads from
the derived weather logs so the ingest path runs on the test tables: one payload
per (city, run)
where a run is a block of ``RUN_SLOTS`` consecutive event offsets — at most one
forecast horizon (7 days x 24 hours) per payload, however large the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.functions import hour_floor, parse_wire, q, wire_time

# Fixed value: one forecast horizon, 7 days of hourly slots.
RUN_SLOTS = 168


def write_payloads(payload: DataFrame, path: str) -> None:
    """Land payloads as JSON documents, one to a line."""
    payload.write.mode("append").option("ignoreNullFields", "false").json(path)


def read_payloads(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed forecast documents (``schemas.PAYLOAD_*``), one to a line; what is no such
    document comes as a row of NULLs, which yields no event."""
    return spark.read.schema(schema).json(path)


def _zip_shortest(arrays: dict[str, Column]) -> Column:
    n = F.least(*[F.size(a) for a in arrays.values()])
    return F.arrays_zip(*[F.slice(a, 1, n).alias(name) for name, a in arrays.items()])


def _explode(payload: DataFrame, arrays: dict[str, Column]) -> DataFrame:
    zipped = payload.select("local", "run", _zip_shortest(arrays).alias("z"))
    return zipped.select("local", "run", F.posexplode("z").alias("pos", "e"))


def _offset(order: str) -> Column:
    if order == "pair":
        return F.struct(F.col("run"), F.col("pos").cast("bigint").alias("pos"))
    if order != "slot":
        raise ValueError(f"order is 'slot' or 'pair', not {order!r}")
    full = F.raise_error(F.lit(f"a document of more than {RUN_SLOTS} slots: use order='pair'")).cast("bigint")
    return F.when(F.col("pos") < RUN_SLOTS, F.col("run") * RUN_SLOTS + F.col("pos")).otherwise(full)


def horizon(df: DataFrame, now: str | None, time: str = "hora") -> DataFrame:
    """Keep rows at or after the start of the hour of ``now`` (no-op when ``now`` is None)."""
    if now is None:
        return df
    start = hour_floor(F.lit(now).cast("timestamp_ntz"))
    return df.filter(F.col(time) >= start)


def ingest_hourly(payload: DataFrame, now: str | None = None, order: str = "slot") -> DataFrame:
    """Hourly weather payload -> ``off, local, hora, temperatura, pp``."""
    h = F.col("hourly")
    rows = _explode(payload, {"time": h["time"], "temperature_2m": h["temperature_2m"],
                              "precipitation_probability": h["precipitation_probability"]})
    out = rows.select(_offset(order).alias("off"), "local", parse_wire(F.col("e.time")).alias("hora"),
                      F.col("e.temperature_2m").alias("temperatura"),
                      F.col("e.precipitation_probability").alias("pp"))
    return horizon(out, now)


def ingest_uv(payload: DataFrame, now: str | None = None, order: str = "slot") -> DataFrame:
    """Hourly UV payload -> ``off, local, hora, uv_index``."""
    h = F.col("hourly")
    rows = _explode(payload, {"time": h["time"], "uv_index": h["uv_index"]})
    out = rows.select(_offset(order).alias("off"), "local", parse_wire(F.col("e.time")).alias("hora"),
                      F.col("e.uv_index").alias("uv_index"))
    return horizon(out, now)


def ingest_daily(payload: DataFrame, order: str = "slot") -> DataFrame:
    """Daily payload -> ``off, local, sunrise, sunset`` (no horizon filter)."""
    d = F.col("daily")
    rows = _explode(payload, {"sunrise": d["sunrise"], "sunset": d["sunset"]})
    return rows.select(_offset(order).alias("off"), "local",
                       parse_wire(F.col("e.sunrise")).alias("sunrise"),
                       parse_wire(F.col("e.sunset")).alias("sunset"))


def split_topics(rows: DataFrame, topics: dict[str, Sequence[str]],
                 keep: Sequence[str] = ("off", "local")) -> DataFrame:
    """Fan one row set out to several topics in ONE pass: each row becomes one row per
    topic (``topic`` + the kept columns + that topic's value columns, NULL for the
    others) via ``inline`` over an array of per-topic structs — no union, so the
    input is computed once."""
    types = dict(rows.dtypes)
    cols = list(keep) + [c for t in topics.values() for c in t if c not in keep]
    cols = list(dict.fromkeys(cols))
    structs = []
    for topic, tcols in topics.items():
        fields = [f"'topic', '{topic}'"]
        for c in cols:
            v = q(c) if (c in keep or c in tcols) else f"CAST(NULL AS {types[c]})"
            fields.append(f"'{c}', {v}")
        structs.append(f"named_struct({', '.join(fields)})")
    return rows.selectExpr(f"inline(array({', '.join(structs)}))")


# ------------------------------------------------------------------ payload fixtures

def _run(slots: int) -> Column:
    return F.floor(F.col("off") / F.lit(slots)).cast("bigint").alias("run")


def _collect(rows: DataFrame, fields: Sequence[str], slots: int = RUN_SLOTS) -> DataFrame:
    """Per (local, run of ``slots`` offsets): the rows as one array sorted by (hora, off)."""
    elem = F.struct(F.col("hora"), F.col("off"), *[F.col(f) for f in fields])
    return rows.groupBy("local", _run(slots)).agg(F.array_sort(F.collect_list(elem)).alias("a"))


def _arr(field: str, fn=None) -> Column:
    return F.transform(F.col("a"), lambda e: fn(e[field]) if fn else e[field])


def hourly_payloads(temperature_pp: DataFrame, slots: int = RUN_SLOTS) -> DataFrame:
    """``off, local, hora, temperatura, pp`` rows -> hourly payloads."""
    g = _collect(temperature_pp, ["temperatura", "pp"], slots)
    return g.select("local", "run", F.struct(
        _arr("hora", wire_time).alias("time"),
        _arr("temperatura").alias("temperature_2m"),
        _arr("pp").alias("precipitation_probability")).alias("hourly"))


def uv_payloads(uv: DataFrame) -> DataFrame:
    g = _collect(uv, ["uv_index"])
    return g.select("local", "run", F.struct(
        _arr("hora", wire_time).alias("time"), _arr("uv_index").alias("uv_index")).alias("hourly"))


def daily_payloads(sun: DataFrame) -> DataFrame:
    """``off, local, hora (day), sunrise, sunset`` rows -> daily payloads."""
    g = _collect(sun, ["sunrise", "sunset"])
    return g.select("local", "run", F.struct(
        _arr("sunrise", wire_time).alias("sunrise"),
        _arr("sunset", wire_time).alias("sunset")).alias("daily"))

"""Topics as keyed JSON records, file-backed or Kafka.

A topic record is ``key`` (the city), ``value`` (a JSON object), ``off``
(its position in the log) and, where its writer gave one, ``timestamp`` (the time it was
written, which retention goes by).  File-backed topics are folders of JSON-lines files
below a shared folder, so batch and streaming readers see the same data; the
Kafka connector is used only when it is on the classpath
(``format="kafka"``; not the case in the test image).

A batch of a derived stream is one folder of its topic (``write_batch``): it is written
aside and renamed, so it is there whole or not at all, and a retry of a batch that is there
changes nothing.  Its records are placed by key: ``partition`` is a hash of the key, and
``off`` rises within a partition, batch after batch.

``value`` encoding keeps NULL fields (``ignoreNullFields=false``): a producer
that writes ``"pp": null`` must be read back as a NULL, not a missing field.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.functions import parse_wire, tolerant_double
from shoreline.schemas import TOPIC_LOG, TOPIC_RECORD
from shoreline.sources.files import Files

JSON_OPTIONS = {"ignoreNullFields": "false"}


def json_value(cols: Sequence[str | Column]) -> Column:
    """The JSON object of ``cols`` (NULL fields kept), as the record value."""
    return F.to_json(F.struct(*cols), JSON_OPTIONS)


def to_records(df: DataFrame, value_cols: Sequence[str | Column], key: str = "local",
               off: str | None = "off", topic: str | None = None, time: str | None = None) -> DataFrame:
    """Rows -> records of schema ``TOPIC_RECORD`` (and ``timestamp``, from column ``time``)."""
    stamp = [F.col(time).cast("timestamp_ntz").alias("timestamp")] if time else []
    return df.select(
        (F.lit(topic) if topic else F.lit(None).cast("string")).alias("topic"),
        F.col(key).cast("string").alias("key"),
        json_value(value_cols).alias("value"),
        (F.col(off) if off else F.lit(None)).cast("bigint").alias("off"),
        *stamp,
    )


def write_topic(records: DataFrame, path: str, fmt: str = "json", mode: str = "append",
                options: dict[str, str] | None = None) -> None:
    """Append records to a topic.  ``fmt="kafka"`` writes to a broker instead
    (``options`` then carry ``kafka.bootstrap.servers`` and ``topic``)."""
    if fmt == "kafka":
        kafka_records(records, options).write.format("kafka").options(**(options or {})).save()
        return
    records.write.mode(mode).format(fmt).save(path)


# Bits of an offset that count records of one batch in one partition.
_BATCH_BITS = 36


def placed(records: DataFrame, partitions: int, spread: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """Records (key, value, ...) with the topic ``partition`` of their key and ``at``, their
    number there in the order of (key, ``order``, value).  With ``spread`` columns a key's
    records go to one partition per value of those."""
    where = F.pmod(F.xxhash64("key", *spread), F.lit(partitions)).cast("int")
    line = Window.partitionBy("partition").orderBy("key", *order, "value")
    return (records.withColumn("partition", where)
            .withColumn("at", (F.row_number().over(line) - 1).cast("bigint")))


def write_batch(records: DataFrame, path: str, topic: str, batch_id: int, partitions: int = 3,
                spread: Sequence[str] = (), order: Sequence[str] = ()) -> bool:
    """Records (key, value) as batch ``batch_id`` of a topic; False where the batch is there
    already.  Offsets are ``batch_id`` in the high bits and the number in the partition in
    the low ones, so they are unique and rise within a partition."""
    files = Files(records.sparkSession, path)
    name = f"batch-{batch_id:012d}"
    if files.exists(name):
        return False
    at = F.when(F.col("at") < F.lit(1 << _BATCH_BITS), F.col("at")).otherwise(
        F.raise_error(F.lit("a topic partition took too many records in one batch")).cast("bigint"))
    out = placed(records, partitions, spread, order).select(
        F.lit(topic).alias("topic"), "key", "value", (F.lit(batch_id << _BATCH_BITS) + at).alias("off"), "partition")
    aside = f"_writing/{name}-{uuid.uuid4().hex}"
    out.write.json(f"{files.root}/{aside}")
    if files.rename(aside, name):
        return True
    files.delete(aside)                                   # another attempt came first
    return False


def kafka_records(records: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """The columns a broker takes: each record's own topic unless the options name one
    topic for all of them (the broker gives the offsets)."""
    return records.select(*([] if "topic" in (options or {}) else ["topic"]), "key", "value")


def write_counted(records: DataFrame, path: str, topics: Sequence[str], keys: Sequence[str], fmt: str = "json",
                  options: dict[str, str] | None = None) -> list[tuple[str, str | None, int]]:
    """``write_topic`` that says what it wrote: (topic, key, records) of every topic and known
    key, and of all other keys of a topic together (key NULL).  The counts are taken by the
    write itself (an observation), not by a second pass."""
    cells = [(t, k) for t in topics for k in (*keys, None)]
    other = ~F.col("key").isin(list(keys)) | F.col("key").isNull() if keys else F.lit(True)
    seen = Observation()
    counts = [F.count_if((F.col("topic") == t) & (other if k is None else F.col("key") == k)).alias(f"c{i}")
              for i, (t, k) in enumerate(cells)]
    write_topic(records.observe(seen, *counts), path, fmt, options=options)
    got = seen.get
    return [(t, k, got[f"c{i}"]) for i, (t, k) in enumerate(cells) if got[f"c{i}"]]


def _broker_records(raw: DataFrame) -> DataFrame:
    """Records as the broker's connector delivers them -> the columns of a topic here (and
    the ``partition`` its offset counts in)."""
    return raw.select("topic", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"), F.col("offset").alias("off"),
                      F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "partition")


def read_topic(spark: SparkSession, path: str | None, fmt: str = "json",
               options: dict[str, str] | None = None) -> DataFrame:
    """All records of a topic (batch, earliest -> now)."""
    if fmt == "kafka":
        return _broker_records(spark.read.format("kafka").option("startingOffsets", "earliest")
                               .options(**(options or {})).load())
    return spark.read.schema(TOPIC_LOG).option("recursiveFileLookup", "true").format(fmt).load(path)


def stream_records(spark: SparkSession, path: str | None, fmt: str = "json",
                   options: dict[str, str] | None = None) -> DataFrame:
    """The records of a topic as a stream, from the earliest on."""
    if fmt == "kafka":
        return _broker_records(spark.readStream.format("kafka").option("startingOffsets", "earliest")
                               .options(**(options or {})).load())
    return (spark.readStream.schema(TOPIC_LOG).option("recursiveFileLookup", "true").format(fmt)
            .options(**(options or {})).load(path))


def retain(records: DataFrame, now: str, minutes: int, time: str = "timestamp") -> DataFrame:
    """What a log that keeps the last ``minutes`` holds at ``now``: records without a time,
    or older, are gone."""
    kept_from = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return records.where(F.col(time) >= kept_from)


def decode(records: DataFrame, schema: T.StructType, keep: Sequence[str] = ("off",),
           tolerant: bool = False) -> DataFrame:
    """``from_json(value, schema)`` -> typed columns (plus ``keep``).

    ``tolerant=True`` reads DOUBLE fields the lenient way (a number written as text
    is parsed, any other non-numeric text becomes 0.0, NULL stays NULL) instead of
    turning a malformed number into NULL."""
    parsed = records.select(*keep, F.from_json("value", _read_schema(schema, tolerant)).alias("v"))
    return _typed(parsed, schema, keep, tolerant)


def _read_schema(schema: T.StructType, tolerant: bool) -> T.StructType:
    if not tolerant:
        return schema
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DoubleType)
                                       else f.dataType) for f in schema.fields])


def _typed(parsed: DataFrame, schema: T.StructType, keep: Sequence[str], tolerant: bool) -> DataFrame:
    return parsed.select(*keep, *[
        tolerant_double(F.col(f"v.{f.name}")).alias(f.name) if tolerant and isinstance(f.dataType, T.DoubleType)
        else F.col(f"v.{f.name}").alias(f.name) for f in schema.fields])


def split_rejected(records: DataFrame, required: Sequence[str] = ("local", "hora"),
                   times: Sequence[str] = ("hora",)) -> tuple[DataFrame, DataFrame]:
    """Split topic records into (accepted, rejected).

    A record is rejected when its value is not a JSON object or lacks one of the
    ``required`` fields (an *absent* field, unlike an explicit ``null``, which is
    a valid value the null filter handles later), or where one of ``times`` holds
    text that is not a wire time.  Both outputs are lazy filters
    of the same input, so a streaming query can write each to its own sink."""
    keys, ok, readable = _verdict(required, times)
    good = ok & readable
    reason = (F.when(keys.isNull(), F.lit("not a JSON object"))
              .when(~ok, F.lit("missing required field")).otherwise(F.lit("malformed time")))
    return records.where(good), records.where(~good).withColumn("_rejected_reason", reason)


def _verdict(required: Sequence[str], times: Sequence[str]) -> tuple[Column, Column, Column]:
    """(keys, required fields are there, times are readable) of a record's ``value``.  Of a
    field that is given twice the last counts, as in ``decode``."""
    keys = F.json_object_keys(F.col("value"))
    ok = keys.isNotNull()
    for name in required:
        ok = ok & F.array_contains(keys, name)
    readable = F.lit(True)
    for name in times:
        last = F.from_json("value", T.StructType([T.StructField(name, T.StringType())])).getField(name)
        text = F.coalesce(last, F.get_json_object("value", f"$.{name}"))
        readable = readable & (text.isNull() | parse_wire(text).isNotNull())
    return keys, F.coalesce(ok, F.lit(False)), readable


_BAD = "_bad_value"
# Tokens that the parser of the values takes as numbers and JSON does not.
_NO_JSON = ("NaN", "INF", "Infinity")


def decode_accepted(records: DataFrame, schema: T.StructType, required: Sequence[str] = ("local", "hora"),
                    times: Sequence[str] = ("hora",), keep: Sequence[str] = ("off",),
                    tolerant: bool = False) -> DataFrame:
    """``decode`` of the records that ``split_rejected`` accepts, with one parse of a value.

    A value that parsed without fault to the ``required`` fields and to readable ``times`` is
    accepted as it is; only any other is looked at key by key.  The parse is the output of a
    generator, which the optimizer does not copy into the filter."""
    read = _read_schema(schema, tolerant)
    known = {f.name: f.dataType for f in read.fields}
    judged = [n for n in dict.fromkeys([*required, *times]) if n not in known]
    whole = T.StructType([*read.fields, *[T.StructField(n, T.StringType()) for n in judged],
                          T.StructField(_BAD, T.StringType())])
    value = F.from_json("value", whole, {"columnNameOfCorruptRecord": _BAD})
    parsed = records.select(*dict.fromkeys([*keep, "value"]), F.explode(F.array(value)).alias("v"))
    sound = F.col("v").isNotNull() & F.col(f"v.{_BAD}").isNull()
    for name in required:
        sound = sound & F.col(f"v.{name}").isNotNull()
    for name in times:
        text = isinstance(known.get(name, T.StringType()), T.StringType)
        sound = sound & (parse_wire(F.col(f"v.{name}")).isNotNull() if text else F.lit(False))
    for token in _NO_JSON:
        sound = sound & ~F.contains(F.col("value"), F.lit(token))
    _, ok, readable = _verdict(required, times)
    # a CASE, since both sides of an OR are computed for every record
    return _typed(parsed.where(F.when(sound, F.lit(True)).otherwise(ok & readable)), schema, keep, tolerant)

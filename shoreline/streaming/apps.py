"""Structured Streaming versions of the beach chain.

Topics are folders of keyed JSON records (see ``sources.topics``); every
query has its own checkpoint folder below ``spark.checkpoint.dir`` and is run
with ``trigger(availableNow=True)``, so a run resumes exactly where the last
one stopped (after a driver or executor loss too).

One app per stage, each reading what the stages before it wrote; everything is
built-in expressions, with no Python state:

* ``sun_hour_updates`` / ``filtered_updates`` — the table-table joins as one
  ``groupBy(key)`` over the union of the tagged sources (``latest_join``) in
  ``update`` mode; a revision on any side re-emits the joined row.  A key is
  emitted once every side has reported; rows then carry ``present`` instead of
  being filtered: when a newer version fails the null filter the key must
  disappear from the served table, and in ``update`` mode a filtered-out row
  would leave the old version behind.  Records without a time have no key, so
  they leave before the state.
* ``beach_hours`` / ``beach_days`` — the many-to-one sun join with the rules, and
  the periods of the current good hours.  Their stream only says which
  (city, day) changed (``day_changes``); ``refresh_sink`` computes these days
  again from the stored versions with the batch operators and writes them as a
  new version.  The stored tables are the state, so any time value is exact, a
  day needs no bound on its hours in a state store, and a batch executed again
  writes the same days again.  Their inputs are opened by the folders of the
  changed days (``store.StageTable``); no other day is listed or read.
* ``days_ever_good`` — the original accumulation: hours once good stay in the
  day, as one bit each in ``update`` mode, and periods are rebuilt with the
  ``aggregate`` higher-order function.

State of the stages with a state store can expire (``ttl``): an event-time watermark
over the key's own time evicts keys older than the newest time less ``ttl``, in the
JVM.  What arrives for an evicted key is left out; without ``ttl`` every key is kept.

A sink writes each micro-batch to its own ``version=<n>`` folder, in overwrite
mode: a re-executed batch replaces its rows.  A version counts once the list of its
days is written; ``StageTable.compact`` merges versions into a base.  Serving views take the latest
version per key.  Versions are (epoch, batch id); raise the epoch when a stage
starts from a new checkpoint over an old output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.functions import day_of, day_start_sql, hour_floor_sql, plus_hours_sql
from shoreline.operators.joins import fk_join, latest_join_tagged, tag_sources
from shoreline.operators.latest import latest_per_key
from shoreline.operators.periods import GROUP, explode_periods, merge_periods, periods_of
from shoreline.operators.rules import day_flag_sql, good_hour_sql, only_good
from shoreline.schemas import FILTERED_VERSION, HOUR_VERSION, SUN_VERSION
from shoreline.sources import topics
from shoreline.sources.files import Files
from shoreline.streaming.store import StageTable

HOUR_KEY = ("local", "hora")
DAY_KEY = ("local", "dia")
HOUR_VALUES = ("temperatura", "pp", "uv")


# ------------------------------------------------------------------ sources

def topic_stream(spark: SparkSession, path: str | None, schema: T.StructType,
                 required: Sequence[str] = ("local", "hora"), fmt: str = "json",
                 options: dict[str, str] | None = None, tolerant: bool = False) -> DataFrame:
    """Streaming read of a topic (``topics.stream_records``), decoded to ``off`` + typed
    columns.  Records lacking a ``required`` field (or not JSON at all) are left out; read
    them with ``rejected_stream`` and give them their own sink."""
    return topics.decode_accepted(topics.stream_records(spark, path, fmt, options), schema, required,
                                  tolerant=tolerant)


def rejected_stream(spark: SparkSession, path: str | None,
                    required: Sequence[str] = ("local", "hora"), fmt: str = "json",
                    options: dict[str, str] | None = None) -> DataFrame:
    """The records of a topic that ``topic_stream`` leaves out, with a reason."""
    return topics.split_rejected(topics.stream_records(spark, path, fmt, options), required)[1]


def _all_not_null(cols: Sequence[str]) -> Column:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return F.coalesce(cond, F.lit(False))


# ------------------------------------------------------------------ stateful stages

def _timed(log: DataFrame) -> DataFrame:
    return log.where("hora IS NOT NULL")


def expiring(rows: DataFrame, keys: Sequence[str], time: str, ttl: str | None) -> tuple[DataFrame, list[str]]:
    """(rows, grouping keys) whose state is evicted once the key's ``time`` is ``ttl`` older
    than the newest seen.  A watermark wants an instant: the key gets one beside its time,
    read as UTC whatever the session's zone."""
    if not ttl:
        return rows, list(keys)
    parts = [f"{part}({time})" for part in ("year", "month", "day", "hour", "minute")]
    instant = f"make_timestamp({', '.join(parts)}, extract(SECOND FROM {time}), 'UTC')"
    return rows.withColumn("_instant", F.expr(instant)).withWatermark("_instant", ttl), [*keys, "_instant"]


def _latest_join(sources, time: str, ttl: str | None) -> DataFrame:
    tagged, keys = expiring(tag_sources(sources, ["local", time]), ["local", time], time, ttl)
    return latest_join_tagged(tagged, {n: v for n, (_, v) in sources.items()}, keys)


def sun_hour_updates(sunrise: DataFrame, sunset: DataFrame, ttl: str | None = None) -> DataFrame:
    """Latest sunrise with latest sunset per (local, dia), once both have reported."""
    midnight = F.expr(day_start_sql("hora")).alias("day_start")
    rise = _timed(sunrise).select("off", "local", midnight, F.col("hora").alias("sunrise"))
    sets = _timed(sunset).select("off", "local", midnight, F.col("hora").alias("sunset"))
    agg = _latest_join({"sunrise": (rise, ["sunrise"]), "sunset": (sets, ["sunset"])}, "day_start", ttl)
    return agg.select("local", day_of("day_start").alias("dia"), "sunrise", "sunset",
                      _all_not_null(["sunrise", "sunset"]).alias("present"))


def filtered_updates(temperature: DataFrame, precipitation: DataFrame,
                     uv_index: DataFrame, ttl: str | None = None) -> DataFrame:
    """Latest of the three hourly logs per (local, hora), once all have reported."""
    agg = _latest_join({"temperature": (_timed(temperature), ["temperatura"]),
                        "precipitation": (_timed(precipitation), ["pp"]),
                        "uv": (_timed(uv_index).withColumnRenamed("uv_index", "uv"), ["uv"])}, "hora", ttl)
    return agg.select("local", "hora", day_of("hora").alias("dia"), *HOUR_VALUES,
                      _all_not_null(["local", *HOUR_VALUES]).alias("present"))


def day_changes(*versions: DataFrame) -> DataFrame:
    """The (local, dia) of every row that the given version streams bring."""
    changes = versions[0].select(*DAY_KEY)
    for v in versions[1:]:
        changes = changes.unionByName(v.select(*DAY_KEY))
    return changes


def beach_hours(filtered_versions: DataFrame, sun_versions: DataFrame, changed: DataFrame,
                **thresholds) -> DataFrame:
    """Every hour of the ``changed`` days with its day's sun row and the rules.  An hour
    whose day has no sun row yet waits; ``present`` is false where the hour left the
    filtered table."""
    hours = latest_versions(filtered_versions.join(changed, list(DAY_KEY), "left_semi"), ["local", "hora", "dia"],
                            [*HOUR_VALUES, "present"], present=None)
    sun = latest_versions(sun_versions.join(changed, list(DAY_KEY), "left_semi"), DAY_KEY,
                          ["sunrise", "sunset", "present"])
    return fk_join(hours, sun, DAY_KEY).selectExpr(
        "local", "hora", "dia", *HOUR_VALUES, f"{day_flag_sql()} AS isDay",
        f"{good_hour_sql(**thresholds)} AS boaHora", "present")


def beach_days(hour_versions: DataFrame, changed: DataFrame, compat: bool = False) -> DataFrame:
    """Periods of the current good hours of the ``changed`` days; a day without any is one
    row of NULLs (its tombstone)."""
    hours = latest_versions(hour_versions.join(changed, list(DAY_KEY), "left_semi"), ["local", "hora", "dia"],
                            ["isDay", "boaHora", "present"])
    return changed.join(merge_periods(only_good(hours), GROUP, "hora", compat=compat), list(DAY_KEY), "left")


def hour_bit_sql(time: str = "hora") -> str:
    """SQL: the bit of a full hour of the day; any other time is an error, not a lost hour."""
    return (f"CASE WHEN {hour_floor_sql(time)} = {time} THEN shiftleft(1, hour({time})) "
            f"ELSE CAST(raise_error('a time off the full hour: use whole_hours=False') AS INT) END")


def hours_of_bits_sql(bits: str, day: str) -> str:
    """SQL: the sorted times of a day whose hours are set in ``bits``."""
    return (f"transform(filter(sequence(0, 23), h -> getbit({bits}, h) = 1), "
            f"h -> {plus_hours_sql(day_start_sql(day), 'h')})")


def days_ever_good(hour_versions: DataFrame, compat: bool = False, whole_hours: bool = True,
                   ttl: str | None = None) -> DataFrame:
    """Never-retract accumulation: every hour that was ever emitted good stays in its day.

    A day's hours are bits of one integer (``bit_or``), so a group's state is of constant
    size.  Times off the full hour have no bit: ``whole_hours=False`` collects the times
    themselves instead."""
    good = hour_versions.filter(F.col("present") & F.col("boaHora"))
    day_start = F.col("dia").cast("timestamp_ntz").alias("day_start")
    good, keys = expiring(good.select("local", day_start, "isDay", "boaHora", "hora"),
                          ["local", "day_start", "isDay", "boaHora"], "day_start", ttl)
    if whole_hours:
        grouped = good.groupBy(*keys).agg(F.expr(f"bit_or({hour_bit_sql()}) AS bits"))
        horas = F.expr(hours_of_bits_sql("bits", "day_start"))
    else:
        grouped = good.groupBy(*keys).agg(F.collect_set("hora").alias("times"))
        horas = F.array_sort("times")
    grouped = grouped.select("local", F.col("day_start").cast("date").alias("dia"), "isDay", "boaHora", horas.alias("horas"))
    with_periods = grouped.select(*GROUP, periods_of("horas", compat).alias("periodos"))
    return explode_periods(with_periods, keep=GROUP)


# ------------------------------------------------------------------ sinks and serving

def version_number(batch_id: int, epoch: int = 0) -> int:
    return (epoch << 32) + batch_id


#: Small days are merged into fewer tasks only as far as every core keeps one.
_WRITE = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    """The session's settings while the block runs."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def version_sink(path: str, partition_by: Sequence[str] = (), epoch: int = 0):
    """foreachBatch writer: the batch as folder ``version=<n>`` of ``path``, replacing what an
    earlier attempt of the same batch left there.  ``n`` orders by (epoch, batch id).  The
    version is published with the list of its days.  Rows are rebalanced by day: a small day
    becomes one file, and one beyond the advisory partition size is split over tasks.  That
    needs adaptive execution, which a stateful query switches off in its session for the
    plan of its state; that plan is fixed by the time the sink runs."""
    def write(batch: DataFrame, batch_id: int) -> None:
        version = version_number(batch_id, epoch)
        rows = batch.hint("rebalance", *partition_by) if partition_by else batch
        with _settings(batch.sparkSession, _WRITE):
            rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/version={version}")
        StageTable(batch.sparkSession, path, batch.schema).commit(version)
    return write


def refresh_sink(path: str, rebuild: Callable[[DataFrame, list], DataFrame],
                 partition_by: Sequence[str] = ("dia",), epoch: int = 0):
    """foreachBatch writer of a stage that is computed again where its inputs changed:
    ``rebuild`` gets the distinct (local, dia) of the batch and the list of its days, and
    returns their rows, which become a new version.  Rows follow the tables as stored when
    the batch runs; whatever is stored later comes with its own change, so the newest
    version is always right.  The batch is read once; its days, not its rows, visit the
    driver."""
    write = version_sink(path, partition_by, epoch)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        changed = batch.select(*DAY_KEY).dropna().distinct().persist()
        try:
            days = [r.dia for r in changed.select("dia").distinct().collect()]
            write(rebuild(changed, days), batch_id)
        finally:
            changed.unpersist()
    return refresh


def beach_hours_sink(path: str, filtered_path: str, sun_path: str, epoch: int = 0, **thresholds):
    """``refresh_sink`` of the hour stage over the stored filtered hours and sun rows."""
    def rebuild(changed: DataFrame, days: list) -> DataFrame:
        spark = changed.sparkSession
        return beach_hours(read_versions(spark, filtered_path, FILTERED_VERSION, days),
                           read_versions(spark, sun_path, SUN_VERSION, days), changed, **thresholds)
    return refresh_sink(path, rebuild, epoch=epoch)


def beach_days_sink(path: str, hours_path: str, epoch: int = 0, compat: bool = False):
    """``refresh_sink`` of the day stage over the stored hours."""
    def rebuild(changed: DataFrame, days: list) -> DataFrame:
        return beach_days(read_versions(changed.sparkSession, hours_path, HOUR_VERSION, days), changed, compat)
    return refresh_sink(path, rebuild, epoch=epoch)


def read_versions(spark: SparkSession, path: str, schema: T.StructType, days: list | None = None) -> DataFrame:
    """The published versions of a stage over its base (empty where it has written nothing
    yet); with ``days`` only those days' folders are opened."""
    return StageTable(spark, path, schema).read(days)


def stream_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The versions of a stage as a stream.  A batch that was executed again replaced its
    files, so one that is gone by now is passed over: its successor comes as well."""
    Files(spark, path).ensure()
    return spark.readStream.schema(schema).option("ignoreMissingFiles", "true").parquet(path)


def topic_sink(path: str, topic: str, key: str = "local", records=None, partitions: int = 3,
               spread: Sequence[str] = (), order: Sequence[str] = ()):
    """foreachBatch writer: the batch as keyed JSON topic records (``key`` + the other
    columns as a JSON value, NULL fields kept) — the wire form of a derived stream.
    ``records`` may shape the batch into ``key, value`` itself (e.g. the beachDay
    wire form with text booleans).

    A batch is one folder of the topic, which appears whole by a rename, so a batch executed
    again finds it there and changes nothing.  Every key's records go to one of
    ``partitions`` (a hot key to several with ``spread``) and offsets rise within each
    (``topics.write_batch``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        columns = list(dict.fromkeys([*spread, *order]))
        if records is not None:
            shaped = records(batch)
            shaped = shaped.select("key", "value", *[c for c in columns if c in shaped.columns])
        else:
            values = [c for c in batch.columns if c != key]
            shaped = batch.select(F.col(key).cast("string").alias("key"),
                                  topics.json_value([key, *values]).alias("value"), *columns)
        topics.write_batch(shaped, path, topic, batch_id, partitions, spread, order)
    return write


def debug_console(updates: DataFrame, name: str, checkpoint: str):
    """Print every emitted row (development aid): the console sink in update mode."""
    return (updates.writeStream.outputMode("update").format("console")
            .option("truncate", "false").option("checkpointLocation", checkpoint)
            .queryName(name).start())


def start_periodic(updates: DataFrame, sink, checkpoint: str, name: str,
                   every: str = "1 hour", partitions: int | None = None):
    """Long-running form: a micro-batch every ``every`` (the producers' hourly cadence).
    ``sink`` is a foreachBatch writer such as ``version_sink`` or ``topic_sink``."""
    with state_store(updates.sparkSession, partitions):
        return (updates.writeStream.outputMode("update").foreachBatch(sink)
                .option("checkpointLocation", checkpoint).queryName(name)
                .trigger(processingTime=every).start())


_PARTITIONS = "spark.sql.shuffle.partitions"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession, partitions: int | None = None):
    """State of queries *started* inside the block: its number of partitions, and RocksDB,
    which spills to disk where the default store must hold all keys in memory.  A batch
    checkpoints the changes it made, not a snapshot of the whole state, so its cost follows
    the batch; snapshots are made in the background.

    A stateful query fixes both at its first start (they are kept in the checkpoint) and
    adaptive execution does not coalesce stateful stages, so on a cluster the number must
    be given; a local master takes one per core.  The session's settings are restored."""
    if partitions is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("give the number of state partitions: the checkpoint keeps it for good")
        partitions = max(1, spark.sparkContext.defaultParallelism)
    with _settings(spark, {_PARTITIONS: str(partitions), _PROVIDER: ROCKSDB, _CHANGELOG: "true"}):
        yield


def run_available_now(updates: DataFrame, sink, checkpoint: str, name: str,
                      partitions: int | None = None):
    """Process everything that has landed since the last run into ``sink`` (a foreachBatch
    writer), then stop; returns the finished query (its ``recentProgress`` holds rows,
    durations and state sizes)."""
    with state_store(updates.sparkSession, partitions):
        q = (updates.writeStream.outputMode("update")
             .foreachBatch(sink)
             .option("checkpointLocation", checkpoint)
             .queryName(name)
             .trigger(availableNow=True)
             .start())
    q.awaitTermination()
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"streaming query {name} failed: {err}")
    return q


def latest_versions(versions: DataFrame, keys: Sequence[str],
                    values: Sequence[str] | None = None, present: str | None = "present"
                    ) -> DataFrame:
    """Served table: latest version per key, keys whose latest version is absent dropped."""
    latest = latest_per_key(versions, list(keys), values, order="version")
    if present:
        latest = latest.filter(F.col(present)).drop(present)
    return latest.drop("version")


def serve_days(day_versions: DataFrame, group_key: Sequence[str] = GROUP,
               version_col: str = "version") -> DataFrame:
    """Rows of the latest version of each group (a group re-emits all its periods)."""
    newest = day_versions.groupBy(*group_key).agg(F.max(version_col).alias("_v"))
    rows = day_versions.join(newest, list(group_key), "inner").filter(F.col(version_col) == F.col("_v"))
    return rows.drop("_v", version_col).distinct()

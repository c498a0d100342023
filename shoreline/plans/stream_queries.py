"""Registered queries: streaming chain and retention (build-plan step 8).

Each streaming query lands the derived weather logs as keyed JSON topics below
the shared folder in ``N_RUNS`` producer runs (contiguous offset ranges, the
whole table), runs the stream app(s) once per run with
``trigger(availableNow=True)`` — every run restarts from the checkpoint — and
returns the served table (latest version per key).  The final served table of
the latest-value stages equals the batch result, so the batch oracles apply.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.functions import parse_wire, plus_minutes, wire_time
from shoreline.operators.changes import apply_feed, change_feed
from shoreline.operators.latest import latest_per_key
from shoreline.operators.periods import GROUP
from shoreline.plans.catalog import register
from shoreline.plans.oracle import BASE_CTES
from shoreline.schemas import BEACH_HOUR_FILTERED_WIRE, DAY_VERSION, FILTERED_VERSION, HOUR_VERSION, SUN_VERSION
from shoreline.session import shared_dir
from shoreline.sources import topics, weather
from shoreline.streaming import apps
from shoreline.streaming.store import StageTable, latest_groups, latest_rows
from shoreline.streaming.supervisor import App, Supervisor

N_RUNS = 3
RETENTION_NOW = "2024-01-30 23:30:00"
RETENTION_MINUTES = 59

_S, _D = T.StringType(), T.DoubleType()
VALUE_SCHEMAS = {
    "temperature": [("temperatura", _D)],
    "precipitationProbability": [("pp", _D)],
    "uvIndex": [("uv_index", _D)],
    "sunrise": [],
    "sunset": [],
}


def _value_schema(name: str) -> T.StructType:
    fields = [T.StructField("local", _S), T.StructField("hora", _S)]
    fields += [T.StructField(n, t) for n, t in VALUE_SCHEMAS[name]]
    return T.StructType(fields)


def run_of(lo: int, hi: int, n: int = N_RUNS):
    """Producer run of an offset: ``n`` contiguous offset ranges over [lo, hi]."""
    return F.expr(f"((off - {lo}) * {n}) div ({hi - lo + 1})")


def _hourly_slots(name: str, log: DataFrame) -> DataFrame:
    return log


def _any_minute(name: str, log: DataFrame) -> DataFrame:
    """The hourly logs with times off the full hour (a rule of the hour, so that the three
    logs still meet on equal keys)."""
    return log.withColumn("hora", plus_minutes(F.col("hora"), F.hour("hora") * 7 % 60)) if name in HOURLY else log


class Landing:
    """The derived logs landed as topics, one producer run at a time."""

    def __init__(self, spark: SparkSession, sf_dir: str, names: list[str], shape=_hourly_slots):
        self.spark = spark
        self.root = shared_dir(spark, "stream")
        base = weather.base(spark, sf_dir)
        bounds = base.agg(F.min("off").alias("lo"), F.max("off").alias("hi")).first()
        # An empty table has no offsets: every run then lands an empty topic.
        self.lo, self.hi = int(bounds["lo"] or 0), int(bounds["hi"] or 0)
        self.tables = {n: shape(n, weather.DERIVE[n](base)) for n in names}

    def path(self, name: str) -> str:
        return f"{self.root}/topics/{name}"

    def out(self, stage: str) -> str:
        return f"{self.root}/{stage}"

    def checkpoint(self, stage: str) -> str:
        return f"{self.root}/_checkpoints/{stage}"

    def table(self, stage: str) -> StageTable:
        return StageTable(self.spark, self.out(stage), VERSIONS[stage])

    def compact(self) -> None:
        """Merge what every stage has stored; all of it was consumed by the stages after it."""
        for stage, merge in MERGES.items():
            table = self.table(stage)
            consumed = max(table.versions(), default=-1)
            table.compact(merge)
            table.vacuum(consumed)

    def land(self, run: int) -> None:
        """The records of a run to their topics, which are written side by side: a run's offsets
        lie in few of the input's splits, so the tasks of one topic leave cores idle."""
        records = {}
        for name, df in self.tables.items():
            fields = ["local", wire_time("hora").alias("hora"), *[n for n, _ in VALUE_SCHEMAS[name]]]
            rows = df.filter(run_of(self.lo, self.hi) == run)
            records[name] = topics.to_records(rows, fields, topic=name)
        with ThreadPoolExecutor(len(records)) as pool:
            # each thread gets local properties of its own
            writes = [pool.submit(inheritable_thread_target(self.spark)(topics.write_topic), rows, self.path(name))
                      for name, rows in records.items()]
        for write in writes:
            write.result()

    def stream(self, name: str) -> DataFrame:
        s = apps.topic_stream(self.spark, self.path(name), _value_schema(name))
        return s.withColumn("hora", parse_wire("hora"))

    def versions(self, stage: str) -> DataFrame:
        return apps.read_versions(self.spark, self.out(stage), VERSIONS[stage])

    def version_stream(self, stage: str) -> DataFrame:
        return apps.stream_versions(self.spark, self.out(stage), VERSIONS[stage])


HOURLY = ["temperature", "precipitationProbability", "uvIndex"]
SUN = ["sunrise", "sunset"]
VERSIONS = {"sunHour": SUN_VERSION, "beachHourFiltered": FILTERED_VERSION, "beachHour": HOUR_VERSION,
            "beachDay": DAY_VERSION, "beachDayEver": DAY_VERSION}

# How a stage's versions merge: of a key its latest row, of a day its latest rows.
MERGES = {"sunHour": latest_rows(["local", "dia"]), "beachHourFiltered": latest_rows(["local", "hora", "dia"]),
          "beachHour": latest_rows(["local", "hora", "dia"]), "beachDay": latest_groups(["local", "dia"])}

# Stage -> (its stream, its sink).
STAGES: dict[str, Callable[[Landing], tuple[DataFrame, Callable]]] = {
    "sunHour": lambda l: (apps.sun_hour_updates(*(l.stream(n) for n in SUN)),
                          apps.version_sink(l.out("sunHour"), ["dia"])),
    "beachHourFiltered": lambda l: (apps.filtered_updates(*(l.stream(n) for n in HOURLY)),
                                    apps.version_sink(l.out("beachHourFiltered"), ["dia"])),
    "beachHour": lambda l: (
        apps.day_changes(l.version_stream("beachHourFiltered"), l.version_stream("sunHour")),
        apps.beach_hours_sink(l.out("beachHour"), l.out("beachHourFiltered"), l.out("sunHour"))),
    "beachDay": lambda l: (apps.day_changes(l.version_stream("beachHour")),
                           apps.beach_days_sink(l.out("beachDay"), l.out("beachHour"))),
    "beachDayEver": lambda l: (apps.days_ever_good(l.version_stream("beachHour")),
                               apps.version_sink(l.out("beachDayEver"), ["dia"])),
}
HOUR_CHAIN = ["beachHourFiltered", "sunHour", "beachHour"]


def run_stages(landing: Landing, stages: list[str]) -> list:
    """Each app once over what has landed since its last run; the finished queries."""
    tag = landing.root.rstrip("/").rsplit("/", 1)[-1][:8]   # unique per landing
    done = []
    for stage in stages:
        updates, sink = STAGES[stage](landing)
        done.append(apps.run_available_now(updates, sink, landing.checkpoint(stage), f"{stage}_{tag}",
                                           partitions=landing.spark.sparkContext.defaultParallelism))
    return done


def _run_chain(spark: SparkSession, sf_dir: str, names: list[str], stages: list[str],
               runs: list[int] | None = None, shape=_hourly_slots) -> Landing:
    landing = Landing(spark, sf_dir, names, shape)
    for run in runs if runs is not None else range(N_RUNS):
        landing.land(run)
        run_stages(landing, stages)
    return landing


def _served_filtered(l: Landing) -> DataFrame:
    return apps.latest_versions(l.versions("beachHourFiltered"), ["local", "hora"],
                                ["temperatura", "pp", "uv", "present"])


def _served_hours(l: Landing) -> DataFrame:
    return apps.latest_versions(l.versions("beachHour"), ["local", "hora"],
                                ["temperatura", "pp", "uv", "isDay", "boaHora", "present"])


@register("stream_sun_hour", "SELECT local, dia, sunrise, sunset FROM sun_hour")
def stream_sun_hour(spark, sf_dir):
    l = _run_chain(spark, sf_dir, SUN, ["sunHour"])
    return apps.latest_versions(l.versions("sunHour"), ["local", "dia"], ["sunrise", "sunset", "present"])


_FILTERED_SQL = "SELECT local, hora, temperatura, pp, uv FROM filtered"
_HOUR_SQL = "SELECT local, hora, temperatura, pp, uv, isDay, boaHora FROM beach_hour"


@register("stream_beach_hour_filtered", _FILTERED_SQL)
def stream_beach_hour_filtered(spark, sf_dir):
    return _served_filtered(_run_chain(spark, sf_dir, HOURLY, ["beachHourFiltered"]))


@register("late_arrival", _FILTERED_SQL)
def late_arrival(spark, sf_dir):
    """The newest run lands first: what lands later with smaller offsets joins the state
    and does not win."""
    return _served_filtered(_run_chain(spark, sf_dir, HOURLY, ["beachHourFiltered"],
                                       runs=list(reversed(range(N_RUNS)))))


@register("stream_beach_hour", _HOUR_SQL)
def stream_beach_hour(spark, sf_dir):
    return _served_hours(_run_chain(spark, sf_dir, HOURLY + SUN, HOUR_CHAIN))


@register("stream_beach_hour_keyed", _HOUR_SQL)
def stream_beach_hour_keyed(spark, sf_dir):
    """The join app runs before the sun app of each run and again after it: hours wait
    for their day's sun row."""
    return _served_hours(_run_chain(spark, sf_dir, HOURLY + SUN,
                                    ["beachHourFiltered", "beachHour", "sunHour", "beachHour"]))


@register("stream_beach_hour_compacted", _HOUR_SQL)
def stream_beach_hour_compacted(spark, sf_dir):
    """After every run the stored versions are merged into the base and deleted; later runs
    and the served table read the base and what came after it."""
    l = Landing(spark, sf_dir, HOURLY + SUN)
    for run in range(N_RUNS):
        l.land(run)
        run_stages(l, [*HOUR_CHAIN, "beachDay"])
        if run < N_RUNS - 1:
            l.compact()
    return _served_hours(l)


@register("stream_wire_topic", _FILTERED_SQL)
def stream_wire_topic(spark, sf_dir):
    """The filtered hours as a keyed JSON topic, every batch written twice; its reader takes
    the latest record of each key."""
    l = Landing(spark, sf_dir, HOURLY)
    out = f"{l.root}/topics/beachHourFiltered"
    records = apps.topic_sink(out, "beachHourFiltered", order=["hora"], records=filtered_records)

    def twice(batch, batch_id):
        records(batch, batch_id)
        records(batch, batch_id)

    for run in range(N_RUNS):
        l.land(run)
        apps.run_available_now(apps.filtered_updates(*(l.stream(n) for n in HOURLY)), twice, l.checkpoint("wire"),
                               f"wire_{l.root[-8:]}", partitions=spark.sparkContext.defaultParallelism)
    wire = T.StructType([*BEACH_HOUR_FILTERED_WIRE.fields, T.StructField("present", T.BooleanType())])
    log = topics.decode(topics.read_topic(spark, out), wire).withColumn("hora", parse_wire("hora"))
    latest = latest_per_key(log, ["local", "hora"], ["temperatura", "pp", "uv", "present"])
    return latest.where("present").select("local", "hora", "temperatura", "pp", "uv")


def filtered_records(rows: DataFrame) -> DataFrame:
    value = topics.json_value(["local", wire_time("hora").alias("hora"), "temperatura", "pp", "uv", "present"])
    return rows.select(F.col("local").alias("key"), value.alias("value"), "hora")


@register("stream_supervised", "SELECT local, dia, isDay, boaHora, inicio, fim FROM beach_day")
def stream_supervised(spark, sf_dir):
    """The apps with their periodic triggers under the supervisor, one of them failing in
    mid-run; they are drained when everything has landed."""
    l = Landing(spark, sf_dir, HOURLY + SUN)
    stages = [*HOUR_CHAIN, "beachDay"]
    broken = {"beachHour"}

    def app(stage):
        def build():
            updates, sink = STAGES[stage](l)

            def write(batch, batch_id):
                if stage in broken:
                    broken.discard(stage)
                    raise RuntimeError("lost in mid-run")
                sink(batch, batch_id)
            return updates, write
        return App(build, l.checkpoint(stage), every="1 second", partitions=spark.sparkContext.defaultParallelism)

    tag = l.root[-8:]
    watch = Supervisor(spark, {f"{s}_{tag}": app(s) for s in stages})
    l.land(0)
    watch.start()
    try:
        watch.settle()
        for run in range(1, N_RUNS):
            l.land(run)
            watch.settle()
    finally:
        watch.stop()
    days = apps.serve_days(l.versions("beachDay"), ["local", "dia"])
    return days.filter(F.col("inicio").isNotNull()).select(*GROUP, "inicio", "fim")


_HOUR_VALUES = ["temperatura", "pp", "uv", "isDay", "boaHora"]


def _two_states(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The served hours after the first producer run and after the last."""
    l = Landing(spark, sf_dir, HOURLY + SUN)
    states = []
    for run in range(N_RUNS):
        l.land(run)
        run_stages(l, HOUR_CHAIN)
        if run in (0, N_RUNS - 1):
            states.append(max(l.table("beachHour").versions(), default=-1))
    old, new = (apps.latest_versions(l.table("beachHour").as_of(v), ["local", "hora"], [*_HOUR_VALUES, "present"])
                for v in states)
    return old, new


def _first_run_sql(columns: str) -> str:
    ctes = BASE_CTES.replace("FROM events)", "FROM events WHERE ((event_id - (SELECT min(event_id) FROM events)) * "
                             f"{N_RUNS}) // ((SELECT max(event_id) FROM events) - (SELECT min(event_id) FROM events) + 1) = 0)", 1)
    return f"(WITH {ctes.strip()} SELECT {columns} FROM beach_hour)"


@register("hour_change_feed", f"""
SELECT coalesce(n.local, o.local) AS local, coalesce(n.hora, o.hora) AS hora,
       CASE WHEN o.local IS NULL THEN 'insert' WHEN n.local IS NULL THEN 'delete' ELSE 'update' END AS op,
       o.temperatura AS old_temperatura, o.isDay AS "old_isDay", o.boaHora AS "old_boaHora",
       n.temperatura AS new_temperatura, n.isDay AS "new_isDay", n.boaHora AS "new_boaHora"
FROM {_first_run_sql('local, hora, temperatura, pp, uv, isDay, boaHora')} o
FULL JOIN (SELECT local, hora, temperatura, pp, uv, isDay, boaHora FROM beach_hour) n
  ON o.local = n.local AND o.hora = n.hora
WHERE (o.temperatura, o.pp, o.uv, o.isDay, o.boaHora) IS DISTINCT FROM (n.temperatura, n.pp, n.uv, n.isDay, n.boaHora)
   OR o.local IS NULL OR n.local IS NULL""")
def hour_change_feed(spark, sf_dir):
    """What changed in the served hours between the first producer run and the last."""
    feed = change_feed(*_two_states(spark, sf_dir), ["local", "hora"], _HOUR_VALUES)
    picked = [F.col(f"{side}.{v}").alias(f"{name}_{v}") for side, name in (("before", "old"), ("after", "new"))
              for v in ("temperatura", "isDay", "boaHora")]
    return feed.select("local", "hora", "op", *picked)


@register("hour_feed_applied", _HOUR_SQL)
def hour_feed_applied(spark, sf_dir):
    """The feed applied to the state after the first run gives the state after the last."""
    old, new = _two_states(spark, sf_dir)
    return apply_feed(old, change_feed(old, new, ["local", "hora"], _HOUR_VALUES), ["local", "hora"], _HOUR_VALUES)


_ANY_TIME_CTES = BASE_CTES.replace(
    "date_trunc('hour', ts) AS hora",
    "date_trunc('hour', ts) + to_minutes(CAST(hour(ts) * 7 % 60 AS BIGINT)) AS hora", 1)


@register("stream_beach_hour_any_time", f"WITH {_ANY_TIME_CTES.strip()} {_HOUR_SQL}", raw_sql=True)
def stream_beach_hour_any_time(spark, sf_dir):
    return _served_hours(_run_chain(spark, sf_dir, HOURLY + SUN, HOUR_CHAIN, shape=_any_minute))


@register("stream_beach_day", "SELECT local, dia, isDay, boaHora, inicio, fim FROM beach_day")
def stream_beach_day(spark, sf_dir):
    l = _run_chain(spark, sf_dir, HOURLY + SUN, [*HOUR_CHAIN, "beachDay"])
    days = apps.serve_days(l.versions("beachDay"), ["local", "dia"])
    return days.filter(F.col("inicio").isNotNull()).select(*GROUP, "inicio", "fim")


def _ever_good_sql() -> str:
    """Union over producer runs of the good hours as of the end of each run."""
    bound = ("((event_id - (SELECT min(event_id) FROM events)) * {n}) // "
             "((SELECT max(event_id) FROM events) - (SELECT min(event_id) FROM events) + 1)")
    parts = []
    for r in range(N_RUNS):
        ctes = BASE_CTES.replace(
            "FROM events)", f"FROM events WHERE {bound.format(n=N_RUNS)} <= {r})", 1)
        parts.append(f"(WITH {ctes.strip()} SELECT local, dia, isDay, boaHora, hora FROM good)")
    return f"""
WITH ever AS (SELECT DISTINCT * FROM ({' UNION ALL '.join(parts)})),
isl AS (
  SELECT *, hora - to_hours(row_number() OVER (PARTITION BY local, dia, isDay, boaHora
                                               ORDER BY hora)) AS grp
  FROM ever)
SELECT local, dia, isDay, boaHora, min(hora) AS inicio, max(hora) + INTERVAL 59 MINUTE AS fim
FROM isl GROUP BY local, dia, isDay, boaHora, grp"""


@register("stream_ever_good", _ever_good_sql(), raw_sql=True)
def stream_ever_good(spark, sf_dir):
    l = _run_chain(spark, sf_dir, HOURLY + SUN, [*HOUR_CHAIN, "beachDayEver"])
    return apps.serve_days(l.versions("beachDayEver"), GROUP)


@register("retention_filter", f"""
SELECT local, hora, temperatura, off FROM (
  SELECT t.*, row_number() OVER (PARTITION BY local, hora ORDER BY off DESC) AS rn
  FROM temperature t JOIN events e ON e.event_id = t.off
  WHERE e.ts >= TIMESTAMP '{RETENTION_NOW}' - INTERVAL {RETENTION_MINUTES} MINUTE)
WHERE rn = 1""")
def retention_filter(spark, sf_dir):
    """Latest temperature per key as a reader of the topic sees it when the log keeps only
    the last 59 minutes of records (record time = event time ``ts``)."""
    path = shared_dir(spark, "topics", "temperatureRetained")
    ev = weather.events(spark, sf_dir)
    temp = weather.temperature_of(weather.base_of(ev)).join(
        ev.select(F.col("event_id").alias("off"), "ts"), "off", "inner")
    topics.write_topic(topics.to_records(temp, ["local", wire_time("hora").alias("hora"), "temperatura"],
                                         topic="temperature", time="ts"), path)
    kept = topics.retain(topics.read_topic(spark, path), RETENTION_NOW, RETENTION_MINUTES)
    log = topics.decode(kept, _value_schema("temperature")).withColumn("hora", parse_wire("hora"))
    return latest_per_key(log, ["local", "hora"], ["temperatura"])

"""Streaming behaviour with explicit micro-batches (G17, G18, G19) and restart."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import DAY, ts
from shoreline import schemas
from shoreline.functions import parse_wire
from shoreline.session import shared_dir
from shoreline.sources import topics
from shoreline.streaming import apps

VALUES = {"temperature": ["temperatura"], "precipitationProbability": ["pp"], "uvIndex": ["uv_index"],
          "sunrise": [], "sunset": []}


class Topics:
    def __init__(self, spark):
        self.spark = spark
        self.root = shared_dir(spark, "test-stream")

    def path(self, name):
        return f"{self.root}/topics/{name}"

    def send(self, name, rows):
        """rows: (off, local, hora datetime, *values)."""
        cols = ["off", "local", "hora", *VALUES[name]]
        schema = ", ".join([f"off long, local string, hora timestamp_ntz"]
                           + [f"{v} double" for v in VALUES[name]])
        df = self.spark.createDataFrame(rows, schema).withColumn(
            "hora", F.date_format("hora", "yyyy-MM-dd'T'HH:mm"))
        topics.write_topic(topics.to_records(df, cols[1:], topic=name), self.path(name))

    def ensure(self, names):
        for n in names:  # an empty topic still needs its folder for the file source
            self.send(n, [])

    def stream(self, name):
        fields = [T.StructField("local", T.StringType()), T.StructField("hora", T.StringType())]
        fields += [T.StructField(v, T.DoubleType()) for v in VALUES[name]]
        return apps.topic_stream(self.spark, self.path(name), T.StructType(fields)) \
            .withColumn("hora", parse_wire("hora"))

    def run(self, stage, build):
        apps.run_available_now(build(), apps.version_sink(f"{self.root}/{stage}", ["dia"]),
                               f"{self.root}/_ckpt/{stage}", stage)

    def refresh(self, stage, changes, sink):
        apps.run_available_now(changes, sink, f"{self.root}/_ckpt/{stage}", stage)

    def versions(self, stage):
        return apps.read_versions(self.spark, f"{self.root}/{stage}", SCHEMAS[stage])

    def version_stream(self, stage):
        return apps.stream_versions(self.spark, f"{self.root}/{stage}", SCHEMAS[stage])

    def hours(self):
        """Filtered hours, sun rows and the hour stage, each once."""
        self.run("f", lambda: apps.filtered_updates(*(self.stream(n) for n in HOURLY)))
        self.run("s", lambda: apps.sun_hour_updates(self.stream("sunrise"), self.stream("sunset")))
        self.refresh("h", apps.day_changes(self.version_stream("f"), self.version_stream("s")), self.hours_sink())

    def hours_sink(self):
        return apps.beach_hours_sink(f"{self.root}/h", f"{self.root}/f", f"{self.root}/s")

    def days(self):
        self.refresh("latest", apps.day_changes(self.version_stream("h")), self.days_sink())

    def days_sink(self):
        return apps.beach_days_sink(f"{self.root}/latest", f"{self.root}/h")

    def served_hours(self):
        return apps.latest_versions(self.versions("h"), ["local", "hora"], ["isDay", "boaHora", "present"])

    def served_days(self):
        return apps.serve_days(self.versions("latest"), ["local", "dia"]).filter("inicio IS NOT NULL")


HOURLY = ["temperature", "precipitationProbability", "uvIndex"]
SCHEMAS = {"f": schemas.FILTERED_VERSION, "s": schemas.SUN_VERSION, "h": schemas.HOUR_VERSION,
           "latest": schemas.DAY_VERSION, "ever": schemas.DAY_VERSION}


def test_g17_join_emits_when_last_side_arrives_and_on_revision(spark):
    t = Topics(spark)
    t.ensure(HOURLY)
    build = lambda: apps.filtered_updates(*(t.stream(n) for n in HOURLY))
    served = lambda: apps.latest_versions(t.versions("f"), ["local", "hora"],
                                          ["temperatura", "pp", "uv", "present"])
    t.send("uvIndex", [(1, "A", ts(7), 2.0)])
    t.run("f", build)
    assert served().count() == 0
    t.send("temperature", [(2, "A", ts(7), 25.0)])
    t.run("f", build)
    assert served().count() == 0
    t.send("precipitationProbability", [(3, "A", ts(7), 10.0)])
    t.run("f", build)
    assert [(r["temperatura"], r["pp"], r["uv"]) for r in served().collect()] == [(25.0, 10.0, 2.0)]
    t.send("temperature", [(4, "A", ts(7), 27.0)])
    t.run("f", build)
    assert [r["temperatura"] for r in served().collect()] == [27.0]
    # a newer NULL retracts the row from the served table
    t.send("uvIndex", [(5, "A", ts(7), None)])
    t.run("f", build)
    assert served().count() == 0


def test_g18_sun_after_hours_emits_all_hours_and_again_on_revision(spark):
    t = Topics(spark)
    t.ensure(HOURLY + ["sunrise", "sunset"])
    for h, off in ((7, 1), (8, 4)):
        t.send("temperature", [(off, "A", ts(h), 25.0)])
        t.send("precipitationProbability", [(off + 1, "A", ts(h), 10.0)])
        t.send("uvIndex", [(off + 2, "A", ts(h), 1.0)])
    t.hours()
    v = t.versions("h")
    assert v.filter("present").count() == 0
    t.send("sunrise", [(10, "A", ts(6, 30))])
    t.send("sunset", [(11, "A", ts(17, 40))])
    t.hours()
    v = t.versions("h")
    last = v.agg(F.max("version")).first()[0]
    emitted = {r["hora"].hour for r in v.filter((F.col("version") == last) & F.col("present")).collect()}
    assert emitted == {7, 8}
    t.send("sunset", [(12, "A", ts(17, 50))])
    t.hours()
    v = t.versions("h")
    last2 = v.agg(F.max("version")).first()[0]
    assert last2 > last
    emitted = {r["hora"].hour for r in v.filter((F.col("version") == last2) & F.col("present")).collect()}
    assert emitted == {7, 8}


def test_g19_ever_good_keeps_hour_latest_removes_it(spark):
    t = Topics(spark)
    t.ensure(HOURLY + ["sunrise", "sunset"])
    t.send("sunrise", [(1, "A", ts(6, 30))])
    t.send("sunset", [(2, "A", ts(17, 40))])
    t.send("temperature", [(3, "A", ts(9), 25.0), (3, "A", ts(10), 25.0)])
    t.send("precipitationProbability", [(4, "A", ts(9), 10.0), (4, "A", ts(10), 10.0)])
    t.send("uvIndex", [(5, "A", ts(9), 1.0), (5, "A", ts(10), 1.0)])

    def stages():
        t.hours()
        t.run("ever", lambda: apps.days_ever_good(t.version_stream("h")))
        t.days()

    stages()
    t.send("temperature", [(9, "A", ts(10), 15.0)])   # 10:00 is no longer good
    stages()
    ever = apps.serve_days(t.versions("ever"), ["local", "dia", "isDay", "boaHora"])
    assert [(r["inicio"].hour, r["fim"].hour) for r in ever.collect()] == [(9, 10)]
    assert [(r["inicio"].hour, r["fim"].hour) for r in t.served_days().collect()] == [(9, 9)]


def test_latest_day_tombstone_when_no_good_hour_left(spark):
    t = Topics(spark)
    t.ensure(HOURLY + ["sunrise", "sunset"])
    t.send("sunrise", [(1, "A", ts(6, 30))])
    t.send("sunset", [(2, "A", ts(17, 40))])
    t.send("temperature", [(3, "A", ts(9), 25.0)])
    t.send("precipitationProbability", [(4, "A", ts(9), 10.0)])
    t.send("uvIndex", [(5, "A", ts(9), 1.0)])

    def stages():
        t.hours()
        t.days()

    stages()
    t.send("precipitationProbability", [(9, "A", ts(9), 90.0)])
    stages()
    assert t.served_days().count() == 0
    assert t.versions("latest").filter("inicio IS NULL").count() == 1


def test_stream_to_keyed_json_topic(spark):
    import json
    t = Topics(spark)
    t.ensure(HOURLY)
    t.send("temperature", [(1, "A", ts(7), 25.0)])
    t.send("precipitationProbability", [(2, "A", ts(7), 10.0)])
    t.send("uvIndex", [(3, "A", ts(7), 1.0)])
    out = f"{t.root}/topics/beachHourFiltered"
    q = (apps.filtered_updates(*(t.stream(n) for n in HOURLY)).writeStream.outputMode("update")
         .foreachBatch(apps.topic_sink(out, "beachHourFiltered"))
         .option("checkpointLocation", f"{t.root}/_ckpt/sink").trigger(availableNow=True).start())
    q.awaitTermination()
    rec = topics.read_topic(spark, out).first()
    v = json.loads(rec["value"])
    assert rec["key"] == "A" and rec["topic"] == "beachHourFiltered"
    assert (v["temperatura"], v["pp"], v["uv"], v["present"]) == (25.0, 10.0, 1.0, True)


def test_periodic_query_processes_new_files(spark):
    t = Topics(spark)
    t.ensure(HOURLY)
    t.send("temperature", [(1, "A", ts(7), 25.0)])
    t.send("precipitationProbability", [(2, "A", ts(7), 10.0)])
    t.send("uvIndex", [(3, "A", ts(7), 1.0)])
    q = apps.start_periodic(apps.filtered_updates(*(t.stream(n) for n in HOURLY)),
                            apps.version_sink(f"{t.root}/f"), f"{t.root}/_ckpt/p", "periodic_test",
                            every="1 second")
    try:
        q.processAllAvailable()
        t.send("temperature", [(4, "A", ts(7), 27.0)])
        q.processAllAvailable()
    finally:
        q.stop()
    served = apps.latest_versions(t.versions("f"), ["local", "hora"],
                                  ["temperatura", "pp", "uv", "present"])
    assert [r["temperatura"] for r in served.collect()] == [27.0]


def test_hour_stage_takes_any_time_and_sun_revisions(spark):
    t = Topics(spark)
    t.ensure(HOURLY + ["sunrise", "sunset"])
    for h, m, off in ((7, 30, 1), (8, 0, 4)):
        _good_hour(t, off, ts(h, m))
    t.hours()                                         # no sun yet: hours wait
    assert t.versions("h").count() == 0
    t.send("sunrise", [(10, "A", ts(7, 45))])
    t.send("sunset", [(11, "A", ts(17, 40))])
    t.hours()
    assert {r["hora"]: r["isDay"] for r in t.served_hours().collect()} == {ts(7, 30): False, ts(8): True}
    t.send("sunrise", [(12, "A", ts(7, 0))])          # revised sunrise: 07:30 becomes day
    t.hours()
    v = t.versions("h")
    last = v.agg(F.max("version")).first()[0]
    assert {r["hora"] for r in v.filter(F.col("version") == last).collect()} == {ts(7, 30), ts(8)}
    assert {r["hora"]: r["isDay"] for r in t.served_hours().collect()} == {ts(7, 30): True, ts(8): True}


def _good_hour(t, off, hora, local="A"):
    t.send("temperature", [(off, local, hora, 25.0)])
    t.send("precipitationProbability", [(off + 1, local, hora, 10.0)])
    t.send("uvIndex", [(off + 2, local, hora, 1.0)])


def test_records_without_a_time_leave_before_the_state(spark):
    t = Topics(spark)
    t.ensure(HOURLY + ["sunrise", "sunset"])
    _good_hour(t, 1, ts(9))
    _good_hour(t, 20, None)                           # an explicit "hora": null is accepted input
    t.send("sunrise", [(4, "A", ts(6, 30)), (30, "A", None)])
    t.send("sunset", [(5, "A", ts(17, 40)), (31, "A", None)])
    t.hours()
    t.days()
    assert [r["hora"] for r in t.served_hours().collect()] == [ts(9)]
    assert [(r["inicio"], r["fim"]) for r in t.served_days().collect()] == [(ts(9), ts(9, 59))]


def test_a_batch_of_the_hour_and_day_stages_executed_again_is_replaced(spark):
    t = Topics(spark)
    t.ensure(HOURLY + ["sunrise", "sunset"])
    _good_hour(t, 1, ts(9))
    t.send("sunrise", [(4, "A", ts(6, 30))])
    t.send("sunset", [(5, "A", ts(17, 40))])
    t.hours()
    t.days()
    changed = spark.createDataFrame([("A", DAY)], "local string, dia date")
    for batch in (0, 0):
        t.hours_sink()(changed, batch)
        t.days_sink()(changed, batch)
    assert t.versions("h").count() == 1 and t.versions("latest").count() == 1
    # A retry after the inputs moved on replaces the batch's rows as well.
    t.send("temperature", [(9, "A", ts(9), 5.0)])
    t.hours()
    last = t.versions("latest").agg(F.max("version")).first()[0]
    t.days_sink()(changed, last)
    assert t.served_days().count() == 0
    # The streams go on after their input was replaced.
    _good_hour(t, 20, ts(10))
    t.hours()
    t.days()
    assert [(r["inicio"], r["fim"]) for r in t.served_days().collect()] == [(ts(10), ts(10, 59))]


def test_a_new_epoch_wins_over_every_batch_of_the_old_one(spark):
    path = shared_dir(spark, "test-epoch")
    row = lambda v: spark.createDataFrame([("A", ts(7), v)], "local string, hora timestamp_ntz, temperatura double")
    for batch in (0, 1, 2):
        apps.version_sink(path)(row(float(batch)), batch)
    apps.version_sink(path, epoch=1)(row(9.0), 0)
    served = apps.latest_versions(spark.read.parquet(path), ["local", "hora"], ["temperatura"], present=None)
    assert [r["temperatura"] for r in served.collect()] == [9.0]


def test_stream_leaves_out_records_without_key_fields(spark):
    t = Topics(spark)
    t.ensure(HOURLY)
    t.send("temperature", [(1, "A", ts(7), 25.0)])
    t.send("precipitationProbability", [(2, "A", ts(7), 10.0)])
    t.send("uvIndex", [(3, "A", ts(7), 1.0)])
    bad = spark.createDataFrame([("temperature", "A", '{"local":"A","temperatura":99.0}', 9)],
                                "topic string, key string, value string, off long")
    topics.write_topic(bad, t.path("temperature"))
    t.run("f", lambda: apps.filtered_updates(*(t.stream(n) for n in HOURLY)))
    served = apps.latest_versions(t.versions("f"), ["local", "hora"],
                                  ["temperatura", "pp", "uv", "present"])
    assert [(r["hora"], r["temperatura"]) for r in served.collect()] == [(ts(7), 25.0)]
    q = (apps.rejected_stream(spark, t.path("temperature")).writeStream
         .foreachBatch(apps.version_sink(f"{t.root}/rejected"))
         .option("checkpointLocation", f"{t.root}/_ckpt/rejected").trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r["off"] for r in spark.read.parquet(f"{t.root}/rejected").collect()] == [9]


def test_reexecuted_batch_does_not_change_the_served_table(spark):
    path = shared_dir(spark, "test-idempotent")
    sink = apps.version_sink(path)
    b0 = spark.createDataFrame([("A", ts(7), 25.0, True), ("A", ts(8), 26.0, True)],
                               "local string, hora timestamp_ntz, temperatura double, present boolean")
    b1 = spark.createDataFrame([("A", ts(8), 30.0, True)],
                               "local string, hora timestamp_ntz, temperatura double, present boolean")
    sink(b0, 0)
    sink(b1, 1)
    once = sorted(tuple(r) for r in apps.latest_versions(
        spark.read.parquet(path), ["local", "hora"], ["temperatura", "present"]).collect())
    sink(b1, 1)                      # the same batch id again, as after a retry
    sink(b0, 0)
    twice = sorted(tuple(r) for r in apps.latest_versions(
        spark.read.parquet(path), ["local", "hora"], ["temperatura", "present"]).collect())
    assert once == twice == [("A", ts(7), 25.0), ("A", ts(8), 30.0)]


def test_day_periods_stream_to_wire_topic(spark):
    import json
    from shoreline.plans.wire_queries import beach_day_records
    t = Topics(spark)
    t.ensure(HOURLY + ["sunrise", "sunset"])
    t.send("sunrise", [(1, "A", ts(6, 30))])
    t.send("sunset", [(2, "A", ts(17, 40))])
    for h, off in ((9, 3), (10, 6)):
        t.send("temperature", [(off, "A", ts(h), 25.0)])
        t.send("precipitationProbability", [(off + 1, "A", ts(h), 10.0)])
        t.send("uvIndex", [(off + 2, "A", ts(h), 1.0)])
    t.hours()
    out = f"{t.root}/topics/beachDay"
    q = (apps.days_ever_good(t.version_stream("h")).writeStream.outputMode("update")
         .foreachBatch(apps.topic_sink(out, "beachDay", records=beach_day_records))
         .option("checkpointLocation", f"{t.root}/_ckpt/wire").trigger(availableNow=True).start())
    q.awaitTermination()
    rec = topics.read_topic(spark, out).first()
    assert rec["key"] == "A" and rec["topic"] == "beachDay"
    assert json.loads(rec["value"]) == {"local": "A", "isDay": "true", "dia": "2024-01-05",
                                        "boaHora": "true", "inicio": "2024-01-05T09:00",
                                        "fim": "2024-01-05T10:59"}


def test_a_doubled_batch_serves_each_period_once(spark):
    rows = [("rio", "2024-01-08", False, True, "2024-01-08 07:00:00", v) for v in (0, 1, 1)]
    df = spark.createDataFrame(rows, "local string, dia string, isDay boolean, boaHora boolean, inicio string, version long")
    assert apps.serve_days(df).count() == 1
    assert apps.serve_days(df.withColumnRenamed("version", "day_version"), ["local", "dia"], "day_version").count() == 1


def test_the_topics_of_a_run_are_landed_side_by_side(spark, monkeypatch):
    import threading

    from shoreline.plans import stream_queries as sq
    from shoreline.sources import weather

    sf, names = "/root/testdata/sf0.001", sq.HOURLY + sq.SUN
    under_way, write = threading.Barrier(len(names), timeout=60), topics.write_topic

    def together(records, path):
        under_way.wait()                                  # broken unless all writes are under way
        write(records, path)

    monkeypatch.setattr(topics, "write_topic", together)
    landing = sq.Landing(spark, sf, names)
    for run in range(sq.N_RUNS):
        landing.land(run)
        for name in names:
            offs = [r.off for r in topics.read_topic(spark, landing.path(name)).select("off").collect()]
            expected = weather.table(spark, sf, name).where(sq.run_of(landing.lo, landing.hi) <= run)
            assert sorted(offs) == sorted(r.off for r in expected.select("off").collect())


def test_a_failed_landing_is_not_passed_over(spark, monkeypatch):
    import pytest

    from shoreline.plans import stream_queries as sq

    write = topics.write_topic

    def broken(records, path):
        if path.endswith("/uvIndex"):
            raise RuntimeError("disk full")
        write(records, path)

    monkeypatch.setattr(topics, "write_topic", broken)
    with pytest.raises(RuntimeError, match="disk full"):
        sq.Landing(spark, "/root/testdata/sf0.001", sq.HOURLY).land(0)

"""Stage tables (day index, compaction, crashes), retry-safe topics, expiring state, hour
bits, change feed, supervision."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import DAY, ts
from shoreline import schemas
from shoreline.operators.changes import apply_feed, change_feed
from shoreline.operators.periods import merge_periods
from shoreline.session import shared_dir
from shoreline.sources import payloads, topics
from shoreline.sources.files import Files
from shoreline.streaming import apps
from shoreline.streaming.store import StageTable, latest_groups, latest_rows
from shoreline.streaming.supervisor import App, Supervisor

HOUR_ROW = "local string, hora timestamp_ntz, dia date, temperatura double, pp double, uv double, isDay boolean, boaHora boolean, present boolean"
HOUR_MERGE = latest_rows(["local", "hora", "dia"])


def hour(local, when, temperatura=25.0, present=True, good=True):
    return (local, when, when.date(), temperatura, 1.0, 1.0, True, good, present)


def write(spark, path, version, rows):
    apps.version_sink(path, ["dia"])(spark.createDataFrame(rows, HOUR_ROW), version)


def table(spark, path):
    return StageTable(spark, path, schemas.HOUR_VERSION)


def served(spark, path):
    rows = apps.latest_versions(table(spark, path).read(), ["local", "hora"], ["temperatura", "present"])
    return sorted((r.local, r.hora, r.temperatura) for r in rows.collect())


def opened(df):
    return sorted(df.inputFiles())


@pytest.fixture
def path(spark):
    return shared_dir(spark, "test-store")


def days_of(n):
    return [ts(9) + dt.timedelta(days=i) for i in range(n)]


def test_one_changed_day_of_many_opens_that_day_alone(spark, path):
    write(spark, path, 0, [hour("A", d) for d in days_of(200)])
    write(spark, path, 1, [hour("A", d, 26.0) for d in days_of(3)])
    wanted = days_of(200)[1].date()
    got = table(spark, path).read([wanted])
    files = opened(got)
    assert len(files) == 2 and all(f"dia={wanted}" in f for f in files)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dia" in plan and str(got.where("dia IS NULL").count()) == "0"
    assert got.select("dia").distinct().collect()[0].dia == wanted


def test_refresh_opens_changed_days_and_reads_its_batch_once(spark, path):
    hours, sun = f"{path}/f", f"{path}/s"
    rows = spark.createDataFrame([(f"c{i % 3}", d, d.date(), 25.0, 1.0, 1.0, True) for i, d in enumerate(days_of(40))],
                                 "local string, hora timestamp_ntz, dia date, temperatura double, pp double, uv double, present boolean")
    apps.version_sink(hours, ["dia"])(rows, 0)
    apps.version_sink(sun, ["dia"])(rows.select("local", "dia", (F.col("hora") - F.expr("INTERVAL 3 HOURS")).alias("sunrise"),
                                                (F.col("hora") + F.expr("INTERVAL 8 HOURS")).alias("sunset"), "present"), 0)
    seen = []
    sink = apps.refresh_sink(f"{path}/h", lambda changed, days: seen.append(
        (days, apps.read_versions(spark, hours, schemas.FILTERED_VERSION, days),
         apps.read_versions(spark, sun, schemas.SUN_VERSION, days))) or apps.beach_hours(seen[-1][1], seen[-1][2], changed))
    one = days_of(40)[7].date()
    sink(spark.createDataFrame([("c1", one), ("c1", one), (None, one), ("c1", None)], "local string, dia date"), 0)
    (days, f, s), = seen
    assert days == [one]
    assert all(f"dia={one}" in x for x in opened(f) + opened(s)) and opened(f) and opened(s)
    assert [r.dia for r in table(spark, f"{path}/h").read().collect()] == [one]


def test_compaction_bounds_files_and_keeps_the_table(spark, path):
    for v in range(6):
        write(spark, path, v, [hour(c, d.replace(hour=h), 20.0 + v) for c in "AB" for d in days_of(4) for h in (7, 8 + v)])
    write(spark, path, 6, [hour("A", days_of(1)[0].replace(hour=7), present=False)])
    before = served(spark, path)
    t = table(spark, path)
    t.compact(HOUR_MERGE)
    assert served(spark, path) == before and len(before) == 2 * 4 * 7 - 1
    assert len(opened(t.read())) <= 4 * 2
    t.vacuum(consumed=6)
    assert served(spark, path) == before
    assert not [n for n in t.files.names("") if n.startswith("version=")]
    # a later version of one day: only that day is merged again, the others keep their folders
    write(spark, path, 7, [hour("A", days_of(4)[2], 99.0)])
    held = t.pointer()[1]["days"]
    now = t.compact(HOUR_MERGE)["days"]
    changed = str(days_of(4)[2].date())
    assert {d for d in now if now[d] != held[d]} == {changed}
    assert ("A", days_of(4)[2], 99.0) in served(spark, path)
    t.vacuum(consumed=7)
    assert served(spark, path) == sorted(set(before) - {("A", days_of(4)[2], 20.0 + 1)} | {("A", days_of(4)[2], 99.0)})
    assert t.compact(HOUR_MERGE) == t.pointer()[1]                # nothing newer: nothing to do


def test_a_crash_in_compaction_loses_and_doubles_nothing(spark, path, monkeypatch):
    for v in range(3):
        write(spark, path, v, [hour("A", d, float(v)) for d in days_of(3)])
    before = served(spark, path)
    t = table(spark, path)

    def lost(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:                               # after the base is written, before the pointer
        m.setattr(Files, "write", lost)
        with pytest.raises(OSError):
            t.compact(HOUR_MERGE)
    assert served(spark, path) == before and t.pointer()[0] == -1
    assert len(t.files.names("_base")) == 1                        # the unused folder
    t.compact(HOUR_MERGE)
    assert served(spark, path) == before
    with monkeypatch.context() as m:                               # in the middle of a vacuum
        calls = []
        real = Files.delete
        m.setattr(Files, "delete", lambda self, name: calls.append(name) or (lost() if len(calls) == 3 else real(self, name)))
        with pytest.raises(OSError):
            t.vacuum(consumed=2)
    assert served(spark, path) == before
    t.vacuum(consumed=2)
    assert served(spark, path) == before and len(t.files.names("_base")) == 1
    # a batch executed again after its version was merged changes nothing
    write(spark, path, 2, [hour("A", d, 2.0) for d in days_of(3)])
    assert served(spark, path) == before


def test_two_compactions_at_once_leave_one_pointer(spark, path):
    write(spark, path, 0, [hour("A", ts(7))])
    a, b = table(spark, path), table(spark, path)
    assert a.files.write("_current/0", json.dumps({"through": 0, "days": {}}))
    assert not b.files.write("_current/0", json.dumps({"through": 9, "days": {}}))
    assert b.pointer() == (0, {"through": 0, "days": {}})


def test_a_version_counts_once_its_days_are_listed(spark, path):
    write(spark, path, 0, [hour("A", ts(7))])
    spark.createDataFrame([hour("A", ts(8))], HOUR_ROW).write.partitionBy("dia").parquet(f"{path}/version=1")
    assert [h for _, h, _ in served(spark, path)] == [ts(7)]
    table(spark, path).adopt()                                     # an output from before day lists
    assert [h for _, h, _ in served(spark, path)] == [ts(7), ts(8)]


def test_groups_merge_whole(spark, path):
    day_row = "local string, dia date, isDay boolean, boaHora boolean, inicio timestamp_ntz, fim timestamp_ntz"
    t = StageTable(spark, path, schemas.DAY_VERSION)
    for v, hours in enumerate(([7, 9, 12], [9, 12], [None])):
        rows = [("A", DAY, True, True, h and ts(h), h and ts(h, 59)) for h in hours] + ([("B", DAY, True, True, ts(5), ts(5, 59))] if v == 0 else [])
        apps.version_sink(path, ["dia"])(spark.createDataFrame(rows, day_row), v)
        if v == 1:
            t.compact(latest_groups(["local", "dia"]))
            assert sorted(r.inicio.hour for r in t.read().where("local = 'A'").collect()) == [9, 12]
    days = apps.serve_days(t.read(), ["local", "dia"]).where("inicio IS NOT NULL")
    assert [(r.local, r.inicio.hour) for r in days.collect()] == [("B", 5)]


# ------------------------------------------------------------------ topics

def test_a_doubled_topic_batch_changes_nothing_and_offsets_rise(spark, path):
    rows = [(c, ts(h)) for c in ("A", "B", "C", None) for h in range(20)]
    batch = spark.createDataFrame(rows, "local string, hora timestamp_ntz").repartition(5)
    sink = apps.topic_sink(f"{path}/t", "t", order=["hora"])
    for n in (0, 0, 1, 0, 1):
        sink(batch, n)
    got = topics.read_topic(spark, f"{path}/t").collect()
    assert len(got) == 2 * len(rows)
    assert len({(r.partition, r.off) for r in got}) == len(got)
    for c in ("A", "B", "C", None):
        mine = sorted((r for r in got if r.key == c), key=lambda r: r.off)
        assert len({r.partition for r in mine}) == 1
        assert [json.loads(r.value)["hora"][11:13] for r in mine] == [f"{h:02d}" for h in range(20)] * 2
    # a batch lost while it was written leaves nothing that readers see
    batch.write.json(f"{path}/t/_writing/batch-000000000002-x")
    assert topics.read_topic(spark, f"{path}/t").count() == 2 * len(rows)
    stream = topics.stream_records(spark, f"{path}/t")
    q = stream.writeStream.foreachBatch(apps.version_sink(f"{path}/copy")).option("checkpointLocation", f"{path}/c") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(f"{path}/copy").count() == 2 * len(rows)


def test_a_hot_city_may_span_partitions(spark, path):
    rows = [("hot", i, i % 8) for i in range(400)] + [("cold", i, 0) for i in range(5)]
    records = spark.createDataFrame(rows, "key string, n long, part long").withColumn("value", F.col("n").cast("string"))
    topics.write_batch(records, path, "t", 0, partitions=16, spread=["part"], order=["n"])
    got = topics.read_topic(spark, path).collect()
    assert len({r.partition for r in got if r.key == "hot"}) > 3
    for p in {r.partition for r in got}:
        for k in {r.key for r in got if r.partition == p}:
            values = [int(r.value) for r in sorted(got, key=lambda r: r.off) if r.partition == p and r.key == k]
            assert values == sorted(values)


# ------------------------------------------------------------------ state

def _stream(spark, path, schema):
    Files(spark, path).ensure()
    return spark.readStream.schema(schema).json(path)


def _log(spark, path, name, day, off):
    value = {"t": "temperatura", "p": "pp", "u": "uv_index"}[name]
    rows = [(off, "A", ts(h) + dt.timedelta(days=day), 1.0 + day) for h in range(24)]
    (spark.createDataFrame(rows, f"off long, local string, hora timestamp_ntz, {value} double")
     .coalesce(1).write.mode("append").json(f"{path}/{name}"))


@pytest.mark.parametrize("ttl", [None, "2 days"])
def test_state_expires_by_the_keys_own_time(spark, path, ttl):
    schema = "off long, local string, hora timestamp_ntz, {} double"
    streams = {"t": "temperatura", "p": "pp", "u": "uv_index"}
    rows, state = [], []
    for day in range(4):
        for name in streams:
            _log(spark, path, name, 5 * day, day)
        build = apps.filtered_updates(*(_stream(spark, f"{path}/{n}", schema.format(v)) for n, v in streams.items()), ttl=ttl)
        q = apps.run_available_now(build, apps.version_sink(f"{path}/out", ["dia"]), f"{path}/ck", f"ttl_{path[-6:]}", partitions=2)
        state.append(q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
        rows.append(StageTable(spark, f"{path}/out", schemas.FILTERED_VERSION).read().count())
    assert rows == [24, 48, 72, 96]                       # nothing in time is lost
    assert state == ([24, 48, 72, 96] if ttl is None else [state[0]] * 4) and state[0] <= 24
    for name in streams:                                  # a revision of an hour long past
        _log(spark, path, name, 0, 99)
    build = apps.filtered_updates(*(_stream(spark, f"{path}/{n}", schema.format(v)) for n, v in streams.items()), ttl=ttl)
    apps.run_available_now(build, apps.version_sink(f"{path}/out", ["dia"]), f"{path}/ck", f"ttl_{path[-6:]}", partitions=2)
    assert StageTable(spark, f"{path}/out", schemas.FILTERED_VERSION).read().count() == (120 if ttl is None else 96)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 47), st.booleans()), min_size=1, max_size=40))
def test_hour_bits_equal_the_collected_hours(spark, picked):
    rows = [hour(c, ts(0) + dt.timedelta(hours=h), good=g) for c, h, g in picked]
    df = spark.createDataFrame(rows, HOUR_ROW)
    bits = apps.days_ever_good(df)
    key = lambda d: sorted(tuple(r) for r in d.select("local", "dia", "isDay", "boaHora", "inicio", "fim").collect())
    good = df.where("boaHora").distinct()
    assert key(bits) == key(apps.days_ever_good(df, whole_hours=False)) == key(merge_periods(good))
    assert "bit_or" in bits._jdf.queryExecution().executedPlan().toString()


def test_times_off_the_hour_have_no_bit(spark):
    df = spark.createDataFrame([hour("A", ts(7, 30)), hour("A", ts(8, 30)), hour("A", ts(9))], HOUR_ROW)
    with pytest.raises(Exception, match="whole_hours=False"):
        apps.days_ever_good(df).collect()
    assert [(r.inicio, r.fim) for r in sorted(apps.days_ever_good(df, whole_hours=False).collect())] == [
        (ts(7, 30), ts(8, 59)), (ts(9), ts(9, 59))]


def test_state_store_is_rocksdb_and_its_size_required_on_a_cluster(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with apps.state_store(spark, 3):
            assert spark.conf.get(key) == apps.ROCKSDB and spark.conf.get("spark.sql.shuffle.partitions") == "3"
        assert spark.conf.get(key).endswith("HDFSBackedStateStoreProvider")
    finally:
        spark.conf.set(key, before)

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
    with pytest.raises(ValueError, match="state partitions"), apps.state_store(Cluster):
        pass


# ------------------------------------------------------------------ feed, supervision, sinks

ROW = st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.booleans()))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=7, unique_by=lambda r: r[0]), st.lists(ROW, max_size=7, unique_by=lambda r: r[0]))
def test_feed_applied_to_the_old_state_gives_the_new(spark, old, new):
    make = lambda rows: spark.createDataFrame(rows, "k int, a int, b boolean")
    feed = change_feed(make(old), make(new), ["k"], ["a", "b"])
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(apply_feed(make(old), feed, ["k"], ["a", "b"]).collect()) == order(new)
    ops = {r.k: (r.op, r.before and tuple(r.before), r.after and tuple(r.after)) for r in feed.collect()}
    was, now = {r[0]: r[1:] for r in old}, {r[0]: r[1:] for r in new}
    assert ops == {k: ("insert" if k not in was else "delete" if k not in now else "update", was.get(k), now.get(k))
                   for k in was.keys() | now.keys() if k not in was or k not in now or was[k] != now[k]}


def _counting_app(spark, path, name, fail=()):
    tries = []

    def build():
        def sink(batch, batch_id):
            tries.append(batch_id)
            if len(tries) in fail:
                raise RuntimeError("lost")
            apps.version_sink(f"{path}/{name}")(batch, batch_id)
        return _stream(spark, f"{path}/in", "n long"), sink
    return App(build, f"{path}/ck_{name}", every="1 second", partitions=1), tries


def test_supervisor_restarts_a_failed_app_from_its_checkpoint(spark, path):
    good, _ = _counting_app(spark, path, "good")
    bad, tries = _counting_app(spark, path, "bad", fail={1, 3})
    watch = Supervisor(spark, {f"good_{path[-6:]}": good, f"bad_{path[-6:]}": bad})
    spark.range(5).withColumnRenamed("id", "n").write.json(f"{path}/in/a")
    spark.range(0).withColumnRenamed("id", "n").write.mode("overwrite").json(f"{path}/in")
    spark.range(5).withColumnRenamed("id", "n").coalesce(1).write.mode("append").json(f"{path}/in")
    watch.start()
    try:
        watch.settle()
        spark.range(5, 9).withColumnRenamed("id", "n").coalesce(1).write.mode("append").json(f"{path}/in")
        watch.settle()
    finally:
        watch.stop()
    for name in ("good", "bad"):
        assert sorted(r.n for r in spark.read.parquet(f"{path}/{name}").collect()) == list(range(9))
    assert tries == [0, 0, 1, 1] and sum(watch.restarts.values()) == 2


def test_supervisor_gives_up_after_the_limit(spark, path):
    bad, tries = _counting_app(spark, path, "bad", fail=range(1, 99))
    spark.range(5).withColumnRenamed("id", "n").write.json(f"{path}/in")
    watch = Supervisor(spark, {f"bad_{path[-6:]}": bad}, max_restarts=1)
    watch.start()
    with pytest.raises(RuntimeError, match="failed 2 times"):
        watch.run(until=lambda: False, poll_seconds=0.5)
    assert len(tries) == 2 and not any(q.isActive for q in watch.queries.values())


def test_debug_console_takes_every_row(spark, path):
    spark.createDataFrame([(7, "x"), (8, "y")], "n long, s string").coalesce(1).write.json(f"{path}/in")
    q = apps.debug_console(_stream(spark, f"{path}/in", "n long, s string"), f"debug_{path[-6:]}", f"{path}/ck")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert "Console" in q.recentProgress[0]["sink"]["description"]
    assert sum(p["numInputRows"] for p in q.recentProgress) == 2


def test_a_write_counts_what_it_wrote(spark, path):
    rows = [("t", "A", "1")] * 3 + [("t", "B", "2"), ("u", "A", "3"), ("u", None, "4"), ("u", "Z", "5"), ("v", "A", "6")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "topic string, key string, value string, off long").repartition(4)
    assert topics.write_counted(df, path, ["t", "u"], ["A", "B"]) == [
        ("t", "A", 3), ("t", "B", 1), ("u", "A", 1), ("u", None, 2)]
    assert topics.read_topic(spark, path).count() == len(rows)
    assert topics.write_counted(df.limit(0), f"{path}/none", ["t"], []) == []


def test_served_tables_are_shared_until_their_source_changes(spark, path):
    from shoreline.plans import serving
    source, made = f"{path}/source", []
    spark.createDataFrame([("A", DAY)], "local string, dia date").write.parquet(source)

    def build():
        made.append(1)
        return spark.read.parquet(source)

    for _ in range(2):
        assert serving.served(spark, source, "days", build).count() == 1
    assert len(made) == 1
    other = spark.newSession()                                 # as another application finds it
    assert serving.served(other, source, "days", build).count() == 1 and len(made) == 1
    spark.createDataFrame([("B", DAY)], "local string, dia date").write.mode("append").parquet(source)
    assert serving.served(spark, source, "days", build).count() == 2 and len(made) == 2
    serving.refresh(spark, source, "days")
    assert serving.served(spark, source, "days", build).count() == 2 and len(made) == 3


def test_documents_longer_than_a_run_need_the_pair_order(spark):
    doc = spark.createDataFrame([("A", 0, (["2024-01-05T%02d:00" % (i % 24) for i in range(200)], [float(i) for i in range(200)], [0.0] * 200)),
                                 ("A", 1, (["2024-01-05T00:00"], [-1.0], [0.0]))], schemas.PAYLOAD_HOURLY)
    with pytest.raises(Exception, match="order='pair'"):
        payloads.ingest_hourly(doc).collect()
    rows = payloads.ingest_hourly(doc, order="pair")
    from shoreline.operators.latest import latest_per_key
    got = {r.hora.hour: r.temperatura for r in latest_per_key(rows, ["local", "hora"], ["temperatura"]).collect()}
    assert got == {0: -1.0} | {h: float(max(i for i in range(200) if i % 24 == h)) for h in range(1, 24)}

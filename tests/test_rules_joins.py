"""Latest-per-key, table joins, the FK join and the row rules (golden cases G5-G10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from helpers import DAY, PRECIPITATION, SUNRISE, SUNSET, TEMPERATURE, UV_INDEX, frame, ts
from shoreline.operators.latest import latest_per_key
from shoreline.operators.rules import with_day_flag, with_good_flag
from shoreline.plans import beach


def test_g9_latest_version_wins(spark):
    t = frame(spark, TEMPERATURE, [(1, "A", ts(7), 21.0), (5, "A", ts(7), 25.0),
                                   (3, "A", ts(7), 19.0), (2, "B", ts(7), 30.0)])
    out = {r["local"]: (r["temperatura"], r["off"])
           for r in latest_per_key(t, ["local", "hora"], ["temperatura"]).collect()}
    assert out == {"A": (25.0, 5), "B": (30.0, 2)}


def test_g8_newer_null_hides_older_value(spark):
    t = frame(spark, TEMPERATURE, [(1, "A", ts(7), 25.0)])
    p = frame(spark, PRECIPITATION, [(2, "A", ts(7), 10.0)])
    u = frame(spark, UV_INDEX, [(3, "A", ts(7), 2.0), (9, "A", ts(7), None)])
    assert beach.beach_hour_joined(t, p, u).count() == 1
    assert beach.beach_hour_filtered(t, p, u).count() == 0


def test_g7_null_in_any_value_or_local_removes_row(spark):
    t = frame(spark, TEMPERATURE, [(1, "A", ts(7), None), (1, "A", ts(8), 25.0),
                                   (1, "A", ts(9), 25.0), (1, None, ts(10), 25.0)])
    p = frame(spark, PRECIPITATION, [(2, "A", ts(7), 10.0), (2, "A", ts(8), None),
                                     (2, "A", ts(9), 10.0), (2, None, ts(10), 10.0)])
    u = frame(spark, UV_INDEX, [(3, "A", ts(7), 1.0), (3, "A", ts(8), 1.0),
                                (3, "A", ts(9), None), (3, None, ts(10), 1.0)])
    assert beach.beach_hour_filtered(t, p, u).count() == 0


def test_inner_join_needs_every_source(spark):
    t = frame(spark, TEMPERATURE, [(1, "A", ts(7), 25.0), (1, "A", ts(8), 25.0)])
    p = frame(spark, PRECIPITATION, [(2, "A", ts(7), 10.0)])
    u = frame(spark, UV_INDEX, [(3, "A", ts(7), 1.0), (3, "A", ts(8), 1.0)])
    rows = beach.beach_hour_filtered(t, p, u).collect()
    assert [(r["hora"], r["temperatura"], r["pp"], r["uv"]) for r in rows] == \
        [(ts(7), 25.0, 10.0, 1.0)]


def test_g5_good_hour_thresholds_are_strict(spark):
    rows = [("t20", 20.0, 1.0, 10.0), ("t201", 20.1, 1.0, 10.0),
            ("uv5", 25.0, 5.0, 10.0), ("uv49", 25.0, 4.9, 10.0),
            ("pp30", 25.0, 1.0, 30.0), ("pp29", 25.0, 1.0, 29.0)]
    df = spark.createDataFrame(rows, "case string, temperatura double, uv double, pp double")
    got = {r["case"]: r["boaHora"] for r in with_good_flag(df).collect()}
    assert got == {"t20": False, "t201": True, "uv5": False, "uv49": True,
                   "pp30": False, "pp29": True}


def test_g6_daytime_is_strictly_between_sunrise_and_sunset(spark):
    df = spark.createDataFrame(
        [("rise", ts(6), ts(6), ts(18)), ("set", ts(18), ts(6), ts(18)),
         ("mid", ts(12), ts(6), ts(18)), ("night", ts(3), ts(6), ts(18))],
        "case string, hora timestamp_ntz, sunrise timestamp_ntz, sunset timestamp_ntz")
    got = {r["case"]: r["isDay"] for r in with_day_flag(df).collect()}
    assert got == {"rise": False, "set": False, "mid": True, "night": False}


def _sources(spark, with_sunset=True):
    t = frame(spark, TEMPERATURE, [(1, "A", ts(7), 25.0), (1, "A", ts(12), 25.0)])
    p = frame(spark, PRECIPITATION, [(2, "A", ts(7), 10.0), (2, "A", ts(12), 10.0)])
    u = frame(spark, UV_INDEX, [(3, "A", ts(7), 1.0), (3, "A", ts(12), 1.0)])
    r = frame(spark, SUNRISE, [(4, "A", ts(6, 30))])
    s = frame(spark, SUNSET, [(5, "A", ts(17, 45))] if with_sunset else [])
    return t, p, u, r, s


def test_fk_join_and_rules(spark):
    t, p, u, r, s = _sources(spark)
    hours = beach.beach_hour(beach.beach_hour_filtered(t, p, u), beach.sun_hour(r, s))
    got = {(row["hora"].hour, row["isDay"], row["boaHora"], row["dia"]) for row in hours.collect()}
    assert got == {(7, True, True, DAY), (12, True, True, DAY)}


def test_g10_missing_sunset_removes_the_day(spark):
    t, p, u, r, s = _sources(spark, with_sunset=False)
    assert beach.sun_hour(r, s).count() == 0
    assert beach.beach_hour(beach.beach_hour_filtered(t, p, u), beach.sun_hour(r, s)).count() == 0


def test_latest_join_is_one_exchange(spark):
    t, p, u, _, _ = _sources(spark)
    plan = beach.beach_hour_filtered(t, p, u)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "SortMergeJoin" not in plan


def test_null_hora_is_dropped_by_the_fk_join(spark):
    t = frame(spark, TEMPERATURE, [(1, "A", None, 25.0)])
    p = frame(spark, PRECIPITATION, [(2, "A", None, 10.0)])
    u = frame(spark, UV_INDEX, [(3, "A", None, 1.0)])
    _, _, _, r, s = _sources(spark)
    filtered = beach.beach_hour_filtered(t, p, u)
    assert filtered.count() == 1          # hora is not part of the null filter
    assert beach.beach_hour(filtered, beach.sun_hour(r, s)).filter(F.col("hora").isNull()).count() == 0

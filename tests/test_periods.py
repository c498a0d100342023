"""Period merging: golden cases from the documented example and randomized
equivalence of the three plans against a plain-Python definition."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import DAY, hours_frame, ts
from shoreline.operators.periods import GROUP, merge_periods

PLANS = ["islands", "array", "session"]


def spans(df):
    return sorted((r["inicio"].hour, r["fim"].hour, r["fim"].minute)
                  for r in df.select("inicio", "fim").collect())


@pytest.mark.parametrize("method", PLANS)
def test_g1_documented_example_default_keeps_trailing_hour(spark, method):
    out = merge_periods(hours_frame(spark, [7, 8, 10, 11, 12, 15]), method=method)
    assert spans(out) == [(7, 8, 59), (10, 12, 59), (15, 15, 59)]


@pytest.mark.parametrize("method", ["islands", "array"])
def test_g1_compat_drops_trailing_single_hour(spark, method):
    out = merge_periods(hours_frame(spark, [7, 8, 10, 11, 12, 15]), compat=True, method=method)
    assert spans(out) == [(7, 8, 59), (10, 12, 59)]


@pytest.mark.parametrize("method", ["islands", "array"])
@pytest.mark.parametrize("compat", [False, True])
def test_g2_single_hour_kept_in_both_modes(spark, method, compat):
    out = merge_periods(hours_frame(spark, [9]), compat=compat, method=method)
    assert spans(out) == [(9, 9, 59)]


@pytest.mark.parametrize("method", ["islands", "array"])
@pytest.mark.parametrize("compat", [False, True])
def test_g3_two_consecutive_hours(spark, method, compat):
    out = merge_periods(hours_frame(spark, [7, 8]), compat=compat, method=method)
    assert spans(out) == [(7, 8, 59)]


@pytest.mark.parametrize("method", ["islands", "array"])
def test_g4_gap(spark, method):
    assert spans(merge_periods(hours_frame(spark, [7, 9]), method=method)) == \
        [(7, 7, 59), (9, 9, 59)]
    assert spans(merge_periods(hours_frame(spark, [7, 9]), compat=True, method=method)) == \
        [(7, 7, 59)]


@pytest.mark.parametrize("method", ["islands", "array"])
def test_g13_duplicate_hour_appears_once(spark, method):
    out = merge_periods(hours_frame(spark, [7, 7, 8]), method=method)
    assert spans(out) == [(7, 8, 59)]


@pytest.mark.parametrize("method", PLANS)
def test_g14_periods_do_not_cross_midnight(spark, method):
    next_day = DAY + dt.timedelta(days=1)
    df = hours_frame(spark, [23]).unionByName(hours_frame(spark, [0], day=next_day))
    out = merge_periods(df, method=method)
    assert out.count() == 2


@pytest.mark.parametrize("method", PLANS)
def test_g15_periods_do_not_cross_sunrise(spark, method):
    df = hours_frame(spark, [5], is_day=False).unionByName(hours_frame(spark, [6], is_day=True))
    assert merge_periods(df, method=method).count() == 2


def reference_periods(hours: list[int], compat: bool) -> list[tuple[int, int]]:
    """Maximal runs of consecutive hours; compat drops a final single-hour run when the
    day has more than one hour."""
    hs = sorted(set(hours))
    runs: list[list[int]] = []
    for h in hs:
        if runs and h == runs[-1][1] + 1:
            runs[-1][1] = h
        else:
            runs.append([h, h])
    if compat and len(hs) > 1 and runs[-1][0] == runs[-1][1]:
        runs.pop()
    return [(a, b) for a, b in runs]


def test_randomized_plans_agree_with_definition(spark):
    rng = random.Random(7)
    groups = []
    for g in range(150):
        n = rng.randint(1, 12)
        groups.append((f"c{g}", sorted(rng.sample(range(24), n))))
    schema = hours_frame(spark, [0]).schema
    rows = spark.createDataFrame(
        [(name, DAY, True, True, ts(h)) for name, hours in groups for h in hours], schema).cache()
    for compat in (False, True):
        expected = sorted((name, a, b) for name, hours in groups
                          for a, b in reference_periods(hours, compat))
        for method in (["islands", "array"] if compat else PLANS):
            out = merge_periods(rows, compat=compat, method=method)
            got = sorted((r["local"], r["inicio"].hour, r["fim"].hour)
                         for r in out.select("local", "inicio", "fim").collect())
            assert got == expected, (method, compat)


def test_output_columns(spark):
    out = merge_periods(hours_frame(spark, [7]))
    assert out.columns == [*GROUP, "inicio", "fim"]
    assert dict(out.dtypes)["fim"] == "timestamp_ntz"
    assert out.select(F.col("fim")).first()[0] == ts(7, 59)

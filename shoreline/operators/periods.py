"""Good hours -> per-day groups -> periods of consecutive hours.

Groups are (city, day, isDay, boaHora), so a period never crosses midnight or
a sunrise/sunset boundary.  A group holds the distinct hours of one day, so
its size is bounded by the day (24 for hourly forecasts) whatever the data
volume; nothing here collects an unbounded group.

Three interchangeable plans merge consecutive hours (next == previous + 1h):

* ``islands``  — gaps-and-islands with ``lag`` + running ``sum`` over a window
  partitioned by the group; one shuffle on the group key, then an aggregate
  that reuses that partitioning.  Default batch plan.
* ``array``    — ``collect_set`` + ``array_sort`` + the ``aggregate`` higher-order
  function; works in streaming ``update`` mode, so the streaming chain uses it.
* ``session``  — ``session_window(hora, '1 hour')``; equal to the others for
  hour-aligned times only (it would also merge 10:00 with 10:30).

``compat=True`` reproduces the original loop's quirk: when a group has more
than one hour, a final period made of a single hour is dropped.  The default
keeps it (the documented behaviour: 07,08,10,11,12,15 -> three periods).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions import period_end_sql, plus_hours_sql, q

GROUP = ("local", "dia", "isDay", "boaHora")


def _cols(group: Sequence[str]) -> str:
    return ", ".join(q(g) for g in group)


def group_hours(hours: DataFrame, group: Sequence[str] = GROUP, time: str = "hora",
                out: str = "horas") -> DataFrame:
    """One row per group with the sorted distinct hours (``ARRAY<TIMESTAMP_NTZ>``)."""
    return hours.groupBy(*group).agg(F.expr(f"array_sort(collect_set({q(time)})) AS {q(out)}"))


def as_intervalos(hours_col: str = "horas") -> Column:
    """``ARRAY<STRUCT<hora>>`` form of a sorted hour array."""
    return F.expr(f"transform({q(hours_col)}, h -> named_struct('hora', h))")


def periods_sql(arr: str, compat: bool = False) -> str:
    """SQL: ``ARRAY<STRUCT<inicio, lasthour>>`` of the consecutive runs of a sorted distinct
    hour array (``aggregate`` higher-order function; NULL for an empty array)."""
    span = "named_struct('inicio', {a}, 'lasthour', {b})"
    tail = "element_at(acc, -1)"
    step = (f"CASE WHEN h = {plus_hours_sql(tail + '.lasthour', 1)} "
            f"THEN concat(slice(acc, 1, size(acc) - 1), "
            f"array({span.format(a=tail + '.inicio', b='h')})) "
            f"ELSE concat(acc, array({span.format(a='h', b='h')})) END")
    first = f"element_at({arr}, 1)"
    merged = (f"aggregate(slice({arr}, 2, greatest(size({arr}) - 1, 0)), "
              f"array({span.format(a=first, b=first)}), (acc, h) -> {step})")
    if compat:
        # Bind the merged array once (transform over a one-element array) and drop a
        # final single-hour run when the day has more than one hour.
        merged = (f"element_at(transform(array({merged}), m -> CASE WHEN size({arr}) > 1 "
                  f"AND element_at(m, -1).inicio = element_at(m, -1).lasthour "
                  f"THEN slice(m, 1, size(m) - 1) ELSE m END), 1)")
    return f"CASE WHEN size({arr}) > 0 THEN {merged} END"


def periods_of(hours_col: str, compat: bool = False) -> Column:
    """Column form of ``periods_sql`` over the array column ``hours_col``."""
    return F.expr(periods_sql(q(hours_col), compat))


def explode_periods(grouped: DataFrame, periods_col: str = "periodos",
                    keep: Sequence[str] = GROUP) -> DataFrame:
    """One row per period: group columns + ``inicio`` + ``fim`` (= last hour + 59 min)."""
    return (grouped
            .selectExpr(*[q(k) for k in keep], f"inline({q(periods_col)})")
            .selectExpr(*[q(k) for k in keep], "inicio", f"{period_end_sql('lasthour')} AS fim"))


def merge_periods_array(hours: DataFrame, group: Sequence[str] = GROUP, time: str = "hora",
                        compat: bool = False) -> DataFrame:
    grouped = group_hours(hours, group, time)
    with_periods = grouped.selectExpr(*[q(c) for c in group],
                                      f"{periods_sql('horas', compat)} AS periodos")
    return explode_periods(with_periods, keep=group)


def merge_periods_islands(hours: DataFrame, group: Sequence[str] = GROUP, time: str = "hora",
                          compat: bool = False) -> DataFrame:
    g, t = _cols(group), q(time)
    ordered = f"OVER (PARTITION BY {g} ORDER BY {t})"
    whole = f"OVER (PARTITION BY {g})"
    # A run starts unless the previous hour is this hour (duplicate) or one hour before.
    prev = f"lag({t}) {ordered}"
    marked = hours.selectExpr(
        *[q(c) for c in group], t,
        f"CASE WHEN {prev} IS NULL OR ({t} <> {prev} AND {t} <> {plus_hours_sql(prev, 1)}) "
        f"THEN 1 ELSE 0 END AS _start")
    # Same partitioning and ordering as above: one sort serves both window passes.
    runs = marked.selectExpr(*[q(c) for c in group], t, f"sum(_start) {ordered} AS _run",
                             f"min({t}) {whole} AS _gmin", f"max({t}) {whole} AS _gmax")
    periods = runs.groupBy(*group, "_run").agg(
        F.expr(f"min({t}) AS inicio"), F.expr(f"max({t}) AS _last"),
        F.expr("first(_gmin) AS _gmin"), F.expr("first(_gmax) AS _gmax"))
    if compat:
        periods = periods.where("NOT (_gmin <> _gmax AND inicio = _last AND inicio = _gmax)")
    return periods.selectExpr(*[q(c) for c in group], "inicio", f"{period_end_sql('_last')} AS fim")


def merge_periods_session(hours: DataFrame, group: Sequence[str] = GROUP, time: str = "hora",
                          compat: bool = False) -> DataFrame:
    if compat:
        raise ValueError("compat mode is only defined for the islands and array plans")
    sessions = hours.groupBy(*group, F.session_window(time, "1 hour")).agg(
        F.expr(f"min({q(time)}) AS inicio"), F.expr(f"max({q(time)}) AS _last"))
    return sessions.selectExpr(*[q(c) for c in group], "inicio", f"{period_end_sql('_last')} AS fim")


PLANS = {
    "islands": merge_periods_islands,
    "array": merge_periods_array,
    "session": merge_periods_session,
}


def merge_periods(hours: DataFrame, group: Sequence[str] = GROUP, time: str = "hora",
                  compat: bool = False, method: str = "islands") -> DataFrame:
    """Periods of consecutive hours per group: group columns + ``inicio`` + ``fim``."""
    return PLANS[method](hours, group, time, compat)

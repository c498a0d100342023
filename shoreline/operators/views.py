"""Read-side views: the read models served to users, city filters, sorting and
the calendar projections.

A read model coerces the served rows to the types its reader receives
(times and days as wire text, hour-view numbers as text).  Sorting is a global
``orderBy`` (range-partitioned, no single-task collect) with tie-breakers so
the order is deterministic.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.functions import plus_hours_sql, wire_date_sql, wire_period_end_sql, wire_time_sql
from shoreline.sources.weather import CITY_NAMES


class UnknownCity(ValueError):
    pass


def require_city(city: str, known: Iterable[str] = CITY_NAMES) -> str:
    """Reject a city parameter that is not one of the known cities."""
    known = list(known)
    if city not in known:
        raise UnknownCity(f"unknown city {city!r}; expected one of {known}")
    return city


def for_city(df: DataFrame, city: str, known: Iterable[str] = CITY_NAMES) -> DataFrame:
    name = require_city(city, known).replace("\\", "\\\\").replace("'", "\\'")
    return df.where(f"local = '{name}'")


def known_cities_only(df: DataFrame, cities: DataFrame) -> DataFrame:
    """Rows whose ``local`` is in the city dimension (broadcast only where its measured
    size allows it)."""
    return df.join(cities.select("local").distinct(), "local", "left_semi")


def beach_day_view(day: DataFrame) -> DataFrame:
    return day.selectExpr(
        "local", "isDay", "boaHora",
        f"{wire_date_sql('dia')} AS dia",
        f"{wire_time_sql('inicio')} AS inicio",
        f"{wire_period_end_sql('fim')} AS fim",
    )


def beach_hour_view(hour: DataFrame) -> DataFrame:
    return hour.selectExpr(
        "local", "boaHora", "isDay",
        "CAST(temperatura AS STRING) AS temperatura",
        "CAST(pp AS STRING) AS pp",
        "CAST(uv AS STRING) AS uv",
        f"{wire_time_sql('hora')} AS hora",
    )


def uv_view(uv: DataFrame) -> DataFrame:
    return uv.selectExpr("local", f"{wire_time_sql('hora')} AS hora", "uv_index")


def sorted_periods(view: DataFrame) -> DataFrame:
    return view.orderBy("inicio", "local", "isDay")


def sorted_hours(view: DataFrame) -> DataFrame:
    return view.orderBy("hora", "local")


def sorted_uv(uv: DataFrame) -> DataFrame:
    """The UV log as a view, sorted; ``off`` orders the versions of one hour."""
    return uv_view(uv.orderBy("hora", "local", "off"))


def hour_periods(hours: DataFrame) -> DataFrame:
    """Hour rows as one-hour periods: ``inicio = hora``, ``fim = hora + 1h``."""
    return hours.selectExpr("*", "hora AS inicio", f"{plus_hours_sql('hora', 1)} AS fim")


def calendar_events(periods: DataFrame) -> DataFrame:
    return periods.selectExpr("local", "inicio AS start", "fim AS `end`")


def week_days(week_start: str, days: int = 7) -> tuple[str, str]:
    """The days [first, end) that a period of the window can lie on.  Periods never
    cross midnight, so the range can be applied to the day key before any aggregation
    (``Chain(..., days=...)``); a window that starts after midnight ends within one
    more day."""
    start = dt.datetime.fromisoformat(week_start)
    stop = start + dt.timedelta(days=days)
    end = stop.date() + dt.timedelta(days=1 if stop.time() > dt.time() else 0)
    return start.date().isoformat(), end.isoformat()


def week_window(periods: DataFrame, week_start: str, days: int = 7) -> DataFrame:
    """Periods that start inside [week_start, week_start + days)."""
    start = f"CAST('{week_start}' AS TIMESTAMP_NTZ)"
    return periods.where(f"inicio >= {start} AND inicio < {start} + make_dt_interval({int(days)})")

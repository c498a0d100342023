"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with SQL oracles.

Every query reads the test tables (through the derived weather logs) in full;
parameters (city, week, "now") are fixed here so the oracle can use the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.functions import day_of
from shoreline.operators import views
from shoreline.operators.latest import latest_per_key
from shoreline.operators.periods import as_intervalos
from shoreline.operators.rules import only_day, only_good
from shoreline.plans import beach
from shoreline.plans.oracle import with_base
from shoreline.sources import weather

# Parameters of the parameterised views (shared with the oracles).
CITY = "Ubatuba"
WEEK_START = "2024-01-08 00:00:00"
WEEK_NOON = "2024-01-08 12:00:00"

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, raw_sql: bool = False, wide: bool = False):
    """Register a query; ``sql`` is its oracle, prefixed with the shared CTEs unless
    ``raw_sql`` (``wide``: the CTEs with one "city" per user)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql.strip() if raw_sql else with_base(sql, wide)
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_extensions()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_extensions()
    return dict(_ORACLES)


def _load_extensions() -> None:
    # Modules that register further queries on import.
    from shoreline.plans import (  # noqa: F401
        ingest_queries,
        served_queries,
        stream_queries,
        wire_queries,
    )


def chain(spark: SparkSession, sf_dir: str) -> beach.Chain:
    return beach.Chain.from_testdata(spark, sf_dir)


# --------------------------------------------------------------- step 1: latest per key

@register("latest_temperature", "SELECT local, hora, temperatura, off FROM lt")
def latest_temperature(spark, sf_dir):
    return latest_per_key(weather.temperature(spark, sf_dir), beach.HOUR_KEY, ["temperatura"])


@register("latest_precipitation", "SELECT local, hora, pp, off FROM lp")
def latest_precipitation(spark, sf_dir):
    return latest_per_key(weather.precipitation(spark, sf_dir), beach.HOUR_KEY, ["pp"])


@register("latest_uv", "SELECT local, hora, uv_index, off FROM lu")
def latest_uv(spark, sf_dir):
    return latest_per_key(weather.uv_index(spark, sf_dir), beach.HOUR_KEY, ["uv_index"])


@register("latest_sunrise", "SELECT local, dia, hora, off FROM lr")
def latest_sunrise(spark, sf_dir):
    return latest_per_key(weather.sunrise(spark, sf_dir),
                          ["local", day_of("hora").alias("dia")], ["hora"])


@register("latest_sunset", "SELECT local, dia, hora, off FROM ls")
def latest_sunset(spark, sf_dir):
    return latest_per_key(weather.sunset(spark, sf_dir),
                          ["local", day_of("hora").alias("dia")], ["hora"])


# --------------------------------------------------------------- step 2: table joins

@register("sun_hour", "SELECT local, dia, sunrise, sunset FROM sun_hour")
def sun_hour(spark, sf_dir):
    return chain(spark, sf_dir).sun_hour()


@register("temp_prec_join", """
SELECT lt.local, lt.hora, lt.temperatura, lp.pp
FROM lt JOIN lp ON lt.local = lp.local AND lt.hora = lp.hora""")
def temp_prec_join(spark, sf_dir):
    c = chain(spark, sf_dir)
    return beach.temp_prec(c.temperature, c.precipitation)


@register("beach_hour_joined", "SELECT local, hora, temperatura, pp, uv FROM joined")
def beach_hour_joined(spark, sf_dir):
    return chain(spark, sf_dir).joined()


@register("beach_hour_filtered", "SELECT local, hora, temperatura, pp, uv FROM filtered")
def beach_hour_filtered(spark, sf_dir):
    return chain(spark, sf_dir).filtered()


# --------------------------------------------------------------- step 3: FK join + rules

@register("beach_hour_sun_fk",
          "SELECT local, dia, hora, temperatura, pp, uv, sunrise, sunset FROM hour_sun")
def beach_hour_sun_fk(spark, sf_dir):
    return chain(spark, sf_dir).hour_sun().select(
        "local", "dia", "hora", "temperatura", "pp", "uv", "sunrise", "sunset")


@register("beach_hour",
          "SELECT local, hora, temperatura, pp, uv, isDay, boaHora FROM beach_hour")
def beach_hour_q(spark, sf_dir):
    return chain(spark, sf_dir).beach_hour().select(*beach.BEACH_HOUR_COLS)


@register("good_hours",
          "SELECT local, hora, temperatura, pp, uv, isDay, boaHora FROM good")
def good_hours(spark, sf_dir):
    return only_good(chain(spark, sf_dir).beach_hour()).select(*beach.BEACH_HOUR_COLS)


# --------------------------------------------------------------- step 4: grouping + periods

@register("beach_day_grouped", """
SELECT local, dia, isDay, boaHora, count(*) AS n_horas,
       string_agg(strftime(hora, '%Y-%m-%dT%H:%M'), ',' ORDER BY hora) AS intervalos
FROM good GROUP BY local, dia, isDay, boaHora""")
def beach_day_grouped(spark, sf_dir):
    grouped = beach.beach_day_grouped(chain(spark, sf_dir).beach_hour())
    return grouped.select(
        "local", "dia", "isDay", "boaHora",
        F.size("horas").cast("bigint").alias("n_horas"),
        F.array_join(F.transform(as_intervalos("horas"),
                                 lambda s: F.date_format(s["hora"], "yyyy-MM-dd'T'HH:mm")),
                     ",").alias("intervalos"))


_DAY_SQL = "SELECT local, dia, isDay, boaHora, inicio, fim FROM {}"


@register("beach_day", _DAY_SQL.format("beach_day"))
def beach_day(spark, sf_dir):
    return chain(spark, sf_dir).beach_day()


@register("beach_day_compat", _DAY_SQL.format("beach_day_compat"))
def beach_day_compat(spark, sf_dir):
    return chain(spark, sf_dir).beach_day(compat=True)


@register("beach_day_array", _DAY_SQL.format("beach_day"))
def beach_day_array(spark, sf_dir):
    return chain(spark, sf_dir).beach_day(method="array")


@register("beach_day_array_compat", _DAY_SQL.format("beach_day_compat"))
def beach_day_array_compat(spark, sf_dir):
    return chain(spark, sf_dir).beach_day(compat=True, method="array")


@register("beach_day_session", _DAY_SQL.format("beach_day"))
def beach_day_session(spark, sf_dir):
    return chain(spark, sf_dir).beach_day(method="session")


# Widened key space: one "city" per user (150 keys at sf0.01, 1,500 at sf0.1).

def wide_chain(spark: SparkSession, sf_dir: str) -> beach.Chain:
    return beach.Chain.from_testdata(spark, sf_dir, city_key="user")


@register("beach_hour_wide",
          "SELECT local, hora, temperatura, pp, uv, isDay, boaHora FROM beach_hour", wide=True)
def beach_hour_wide(spark, sf_dir):
    return wide_chain(spark, sf_dir).beach_hour().select(*beach.BEACH_HOUR_COLS)


@register("beach_day_wide", _DAY_SQL.format("beach_day"), wide=True)
def beach_day_wide(spark, sf_dir):
    return wide_chain(spark, sf_dir).beach_day()


@register("beach_day_wide_compat", _DAY_SQL.format("beach_day_compat"), wide=True)
def beach_day_wide_compat(spark, sf_dir):
    return wide_chain(spark, sf_dir).beach_day(compat=True, method="array")


# --------------------------------------------------------------- step 5: read views

_DAY_VIEW_SQL = "SELECT local, isDay, boaHora, dia, inicio, fim FROM beach_day_view"


@register("all_beach_day", _DAY_VIEW_SQL + " ORDER BY inicio, local, isDay")
def all_beach_day(spark, sf_dir):
    return views.sorted_periods(views.beach_day_view(chain(spark, sf_dir).beach_day()))


@register("beach_day_city", _DAY_VIEW_SQL + f" WHERE local = '{CITY}' ORDER BY inicio, isDay")
def beach_day_city(spark, sf_dir):
    day = views.for_city(chain(spark, sf_dir).beach_day(), CITY)
    return views.sorted_periods(views.beach_day_view(day))


_HOUR_VIEW_SQL = "SELECT local, boaHora, isDay, temperatura, pp, uv, hora FROM beach_hour_view"


@register("all_beach_hour", _HOUR_VIEW_SQL + " ORDER BY hora, local")
def all_beach_hour(spark, sf_dir):
    return views.sorted_hours(views.beach_hour_view(chain(spark, sf_dir).beach_hour()))


@register("beach_hour_city", _HOUR_VIEW_SQL + f" WHERE local = '{CITY}' ORDER BY hora")
def beach_hour_city(spark, sf_dir):
    hours = views.for_city(chain(spark, sf_dir).beach_hour(), CITY)
    return views.sorted_hours(views.beach_hour_view(hours))


_UV_VIEW_SQL = ("SELECT local, strftime(hora, '%Y-%m-%dT%H:%M') AS hora, uv_index FROM uv_index")


@register("all_uv_index", _UV_VIEW_SQL + " ORDER BY hora, local")
def all_uv_index(spark, sf_dir):
    return views.sorted_uv(weather.uv_index(spark, sf_dir))


@register("uv_index_city", _UV_VIEW_SQL + f" WHERE local = '{CITY}' ORDER BY hora")
def uv_index_city(spark, sf_dir):
    uv = views.for_city(weather.uv_index(spark, sf_dir), CITY)
    return views.sorted_uv(uv)


@register("calendar_periods", f"""
SELECT local, inicio AS start, fim AS "end" FROM beach_day WHERE local = '{CITY}' AND boaHora""")
def calendar_periods(spark, sf_dir):
    day = views.for_city(chain(spark, sf_dir).beach_day(), CITY)
    return views.calendar_events(only_good(day))


@register("calendar_hours", f"""
SELECT local, hora AS start, hora + INTERVAL 1 HOUR AS "end" FROM beach_hour
WHERE local = '{CITY}' AND boaHora""")
def calendar_hours(spark, sf_dir):
    hours = views.for_city(chain(spark, sf_dir).beach_hour(), CITY)
    return views.calendar_events(views.hour_periods(only_good(hours)))


@register("calendar_day_only", f"""
SELECT local, inicio AS start, fim AS "end" FROM beach_day
WHERE local = '{CITY}' AND boaHora AND isDay""")
def calendar_day_only(spark, sf_dir):
    day = views.for_city(chain(spark, sf_dir).beach_day(), CITY)
    return views.calendar_events(only_day(only_good(day)))


@register("calendar_week", f"""
SELECT local, inicio AS start, fim AS "end" FROM beach_day
WHERE local = '{CITY}' AND boaHora
  AND inicio >= TIMESTAMP '{WEEK_START}' AND inicio < TIMESTAMP '{WEEK_START}' + INTERVAL 7 DAY""")
def calendar_week(spark, sf_dir):
    hours = views.for_city(chain(spark, sf_dir).beach_hour(days=views.week_days(WEEK_START)), CITY)
    day = beach.beach_day(hours)
    return views.calendar_events(views.week_window(only_good(day), WEEK_START))


@register("calendar_week_noon", f"""
SELECT local, inicio AS start, fim AS "end" FROM beach_day
WHERE local = '{CITY}' AND boaHora
  AND inicio >= TIMESTAMP '{WEEK_NOON}' AND inicio < TIMESTAMP '{WEEK_NOON}' + INTERVAL 7 DAY""")
def calendar_week_noon(spark, sf_dir):
    """A window that starts at noon reaches into an eighth day."""
    hours = views.for_city(chain(spark, sf_dir).beach_hour(days=views.week_days(WEEK_NOON)), CITY)
    return views.calendar_events(views.week_window(only_good(beach.beach_day(hours)), WEEK_NOON))


@register("calendar_hours_day_only", f"""
SELECT local, hora AS start, hora + INTERVAL 1 HOUR AS "end" FROM beach_hour
WHERE local = '{CITY}' AND boaHora AND isDay""")
def calendar_hours_day_only(spark, sf_dir):
    """Good hours of the daytime as calendar entries."""
    hours = only_day(only_good(views.for_city(chain(spark, sf_dir).beach_hour(), CITY)))
    return views.calendar_events(views.hour_periods(hours))


@register("known_city_semi", """
SELECT local, hora, temperatura, pp, uv, isDay, boaHora FROM beach_hour
WHERE local IN (SELECT local FROM (VALUES """ + ", ".join(
    f"('{c}')" for c in weather.CITY_NAMES) + """) AS c(local))""")
def known_city_semi(spark, sf_dir):
    from shoreline.sources.cities import city_dimension
    hours = chain(spark, sf_dir).beach_hour().select(*beach.BEACH_HOUR_COLS)
    return views.known_cities_only(hours, city_dimension(spark))

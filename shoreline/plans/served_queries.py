"""Registered queries: read views served from materialized stage tables."""

from __future__ import annotations

from shoreline.operators import views
from shoreline.operators.rules import only_good
from shoreline.plans.catalog import CITY, WEEK_START, chain, register
from shoreline.plans.beach import BEACH_HOUR_COLS, Chain
from shoreline.plans.serving import served
from shoreline.sources import weather

_DAY_VIEW_SQL = "SELECT local, isDay, boaHora, dia, inicio, fim FROM beach_day_view"


@register("served_calendar_week", f"""
SELECT local, inicio AS start, fim AS "end" FROM beach_day
WHERE local = '{CITY}' AND boaHora
  AND inicio >= TIMESTAMP '{WEEK_START}' AND inicio < TIMESTAMP '{WEEK_START}' + INTERVAL 7 DAY""")
def served_calendar_week(spark, sf_dir):
    """Week calendar read from the served beach_day table: the week prunes day
    directories, the city filter uses row-group statistics."""
    day = served(spark, sf_dir, "beachDay", lambda: chain(spark, sf_dir).beach_day())
    first, end = views.week_days(WEEK_START)
    week = day.where(f"dia >= DATE'{first}' AND dia < DATE'{end}'")
    return views.calendar_events(views.week_window(only_good(views.for_city(week, CITY)), WEEK_START))


@register("served_beach_day_city", _DAY_VIEW_SQL + f" WHERE local = '{CITY}'")
def served_beach_day_city(spark, sf_dir):
    day = served(spark, sf_dir, "beachDay", lambda: chain(spark, sf_dir).beach_day())
    return views.sorted_periods(views.beach_day_view(views.for_city(day, CITY)))


@register("served_beach_hour",
          "SELECT local, hora, temperatura, pp, uv, isDay, boaHora, dia FROM beach_hour")
def served_beach_hour(spark, sf_dir):
    return served(spark, sf_dir, "beachHour", lambda: chain(spark, sf_dir).beach_hour())


def five_logs(spark, sf_dir) -> Chain:
    """The chain over five logs stored as five tables, as its users have them: every join
    takes the union path, with a scan per log."""
    base = weather.base(spark, sf_dir)

    def log(name):
        return served(spark, sf_dir, f"log_{name}", lambda: weather.DERIVE[name](base), (), ("off",))

    return Chain(temperature=log("temperature"), precipitation=log("precipitationProbability"),
                 uv_index=log("uvIndex"), sunrise=log("sunrise"), sunset=log("sunset"))


@register("five_log_beach_hour",
          "SELECT local, hora, temperatura, pp, uv, isDay, boaHora FROM beach_hour")
def five_log_beach_hour(spark, sf_dir):
    return five_logs(spark, sf_dir).beach_hour().select(*BEACH_HOUR_COLS)


@register("five_log_beach_day", "SELECT local, dia, isDay, boaHora, inicio, fim FROM beach_day")
def five_log_beach_day(spark, sf_dir):
    return five_logs(spark, sf_dir).beach_day()


@register("five_log_sun_hour", "SELECT local, dia, sunrise, sunset FROM sun_hour")
def five_log_sun_hour(spark, sf_dir):
    return five_logs(spark, sf_dir).sun_hour()

"""The beach chain as batch DataFrame plans.

    sunrise, sunset ──latest_join(local, dia)──────────────► sun_hour
    temperature, pp, uv ──latest_join(local, hora)──► null filter ──► beach_hour_filtered
    beach_hour_filtered ──fk_join(local, dia)── sun_hour ──► isDay, boaHora ──► beach_hour
    beach_hour ──boaHora──► group (local, dia, isDay) ──► merge periods ──► beach_day

Each function takes DataFrames and returns a DataFrame; nothing is collected.
Shuffles for ``beach_day``: one per ``latest_join`` (after map-side partial
aggregation), one for the FK join on (local, dia) unless AQE broadcasts the
measured sun table, and the per-day grouping reuses the join partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoreline.operators.joins import fk_join, latest_join, latest_join_tagged
from shoreline.operators.periods import GROUP, group_hours, merge_periods
from shoreline.operators.rules import day_flag_sql, drop_incomplete, good_hour_sql, only_good
from shoreline.sources import weather

HOUR_KEY = ("local", "hora")
DAY_KEY = ("local", "dia")
BEACH_HOUR_COLS = ("local", "hora", "temperatura", "pp", "uv", "isDay", "boaHora")


def sun_hour(sunrise: DataFrame, sunset: DataFrame) -> DataFrame:
    """Latest sunrise ⋈ latest sunset per (local, day of the report)."""
    rise = sunrise.selectExpr("off", "local", "to_date(hora) AS dia", "hora AS sunrise")
    sets = sunset.selectExpr("off", "local", "to_date(hora) AS dia", "hora AS sunset")
    return latest_join({"sunrise": (rise, ["sunrise"]), "sunset": (sets, ["sunset"])}, DAY_KEY)


def temp_prec(temperature: DataFrame, precipitation: DataFrame) -> DataFrame:
    """Latest temperature ⋈ latest precipitation probability per (local, hora)."""
    return latest_join({"temperature": (temperature, ["temperatura"]),
                        "precipitation": (precipitation, ["pp"])}, HOUR_KEY)


def beach_hour_joined(temperature: DataFrame, precipitation: DataFrame,
                      uv_index: DataFrame) -> DataFrame:
    """Three-way latest join (before the null filter); ``uv_index`` is renamed ``uv``."""
    return latest_join({"temperature": (temperature, ["temperatura"]),
                        "precipitation": (precipitation, ["pp"]),
                        "uv": (uv_index.withColumnRenamed("uv_index", "uv"), ["uv"])}, HOUR_KEY)


def beach_hour_filtered(temperature: DataFrame, precipitation: DataFrame,
                        uv_index: DataFrame) -> DataFrame:
    return drop_incomplete(beach_hour_joined(temperature, precipitation, uv_index))


def beach_hour_sun(filtered: DataFrame, sun: DataFrame) -> DataFrame:
    """Each hour meets the sun row of its (local, day); hours without one vanish."""
    return fk_join(filtered.selectExpr("*", "to_date(hora) AS dia"), sun, DAY_KEY)


def beach_hour(filtered: DataFrame, sun: DataFrame, **thresholds) -> DataFrame:
    """Hours with ``isDay`` and ``boaHora``; keeps ``dia`` for the per-day grouping."""
    joined = beach_hour_sun(filtered, sun)
    return joined.selectExpr("local", "hora", "temperatura", "pp", "uv",
                             f"{day_flag_sql()} AS isDay", f"{good_hour_sql(**thresholds)} AS boaHora",
                             "dia")


def beach_day_grouped(hours: DataFrame) -> DataFrame:
    """Good hours grouped per (local, dia, isDay): sorted distinct hours."""
    return group_hours(only_good(hours), GROUP)


def beach_day(hours: DataFrame, compat: bool = False, method: str = "islands") -> DataFrame:
    """Periods of consecutive good hours: local, dia, isDay, boaHora, inicio, fim."""
    return merge_periods(only_good(hours), GROUP, "hora", compat=compat, method=method)


class Chain:
    """All stages over one set of source logs (lazy DataFrames, built on first use)."""

    def __init__(self, temperature=None, precipitation=None, uv_index=None,
                 sunrise=None, sunset=None, base: DataFrame | None = None):
        self._tables = {"temperature": temperature, "precipitationProbability": precipitation,
                        "uvIndex": uv_index, "sunrise": sunrise, "sunset": sunset}
        self._base = base

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, city_key: str = "city") -> "Chain":
        return cls(base=weather.base(spark, sf_dir, city_key))

    def _table(self, name: str) -> DataFrame:
        if self._tables[name] is None:
            self._tables[name] = weather.DERIVE[name](self._base)
        return self._tables[name]

    @property
    def temperature(self) -> DataFrame:
        return self._table("temperature")

    @property
    def precipitation(self) -> DataFrame:
        return self._table("precipitationProbability")

    @property
    def uv_index(self) -> DataFrame:
        return self._table("uvIndex")

    @property
    def sunrise(self) -> DataFrame:
        return self._table("sunrise")

    @property
    def sunset(self) -> DataFrame:
        return self._table("sunset")

    # When all logs come from one base table (the test data), they are tagged in a
    # single pass instead of one scan per log; the aggregation is the same.
    def _fused(self) -> bool:
        return self._base is not None and all(t is None for t in self._tables.values())

    # ``days=(first, end)`` restricts every stage to days in [first, end) — on the
    # grouping keys, so Catalyst pushes it below the aggregations down to the scans
    # of BOTH join inputs (and prunes day-partitioned logs).
    @staticmethod
    def _days(df: DataFrame, day_expr: str, days: tuple[str, str] | None) -> DataFrame:
        if days is None:
            return df
        first, end = days
        return df.where(f"{day_expr} >= DATE'{first}' AND {day_expr} < DATE'{end}'")

    # The same range on the raw time column of every log, so that each reader gets it
    # (day keys are computed, and a range on them does not always reach the file scan).
    @staticmethod
    def _raw(df: DataFrame, time: str, days: tuple[str, str] | None) -> DataFrame:
        if days is None:
            return df
        first, end = (f"CAST('{d} 00:00:00' AS TIMESTAMP_NTZ)" for d in days)
        return df.where(f"{time} >= {first} AND {time} < {end}")

    def sun_hour(self, days: tuple[str, str] | None = None) -> DataFrame:
        if self._fused():
            sun = latest_join_tagged(weather.tagged_sun(self._raw(self._base, "ts", days)),
                                     {"sunrise": ["sunrise"], "sunset": ["sunset"]}, DAY_KEY)
        else:
            sun = sun_hour(self._raw(self.sunrise, "hora", days), self._raw(self.sunset, "hora", days))
        return self._days(sun, "dia", days)

    def joined(self, days: tuple[str, str] | None = None) -> DataFrame:
        if self._fused():
            hours = latest_join_tagged(weather.tagged_hourly(self._raw(self._base, "ts", days)),
                                       {"temperature": ["temperatura"], "precipitation": ["pp"],
                                        "uv": ["uv"]}, HOUR_KEY)
        else:
            hours = beach_hour_joined(*(self._raw(log, "hora", days)
                                        for log in (self.temperature, self.precipitation, self.uv_index)))
        return self._days(hours, "to_date(hora)", days)

    def filtered(self, days: tuple[str, str] | None = None) -> DataFrame:
        return drop_incomplete(self.joined(days))

    def hour_sun(self, days: tuple[str, str] | None = None) -> DataFrame:
        return beach_hour_sun(self.filtered(days), self.sun_hour(days))

    def beach_hour(self, days: tuple[str, str] | None = None, **thresholds) -> DataFrame:
        return beach_hour(self.filtered(days), self.sun_hour(days), **thresholds)

    def beach_day(self, compat: bool = False, method: str = "islands",
                  days: tuple[str, str] | None = None) -> DataFrame:
        return beach_day(self.beach_hour(days), compat=compat, method=method)

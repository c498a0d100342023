"""Row rules: completeness filter, daytime flag and good-beach-hour flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions import q

# A good beach hour has temperature above 20, UV index below 5
# and precipitation probability below 30 — all strict inequalities.
TEMP_MIN = 20.0
UV_MAX = 5.0
PP_MAX = 30.0


def drop_incomplete(df: DataFrame,
                    cols: Sequence[str] = ("local", "temperatura", "pp", "uv")) -> DataFrame:
    """Drop rows with a NULL in any of ``cols`` (``hora`` is deliberately not checked)."""
    return df.dropna(how="any", subset=list(cols))


def day_flag_sql(time: str = "hora", rise: str = "sunrise", set_: str = "sunset") -> str:
    """``isDay`` = strictly after sunrise and strictly before sunset."""
    return f"coalesce({q(time)} > {q(rise)} AND {q(time)} < {q(set_)}, false)"


def good_hour_sql(temp: str = "temperatura", uv: str = "uv", pp: str = "pp",
                  temp_min: float = TEMP_MIN, uv_max: float = UV_MAX,
                  pp_max: float = PP_MAX) -> str:
    """``boaHora`` = temperature > 20 and uv < 5 and pp < 30 (strict; thresholds are parameters)."""
    return (f"coalesce({q(temp)} > {float(temp_min)!r}D AND {q(uv)} < {float(uv_max)!r}D "
            f"AND {q(pp)} < {float(pp_max)!r}D, false)")


def good_hour_condition(**kw) -> Column:
    return F.expr(good_hour_sql(**kw))


def with_day_flag(df: DataFrame, time: str = "hora", rise: str = "sunrise",
                  set_: str = "sunset", out: str = "isDay") -> DataFrame:
    return df.selectExpr("*", f"{day_flag_sql(time, rise, set_)} AS {q(out)}")


def with_good_flag(df: DataFrame, out: str = "boaHora", **thresholds) -> DataFrame:
    return df.selectExpr("*", f"{good_hour_sql(**thresholds)} AS {q(out)}")


def only_good(df: DataFrame, flag: str = "boaHora") -> DataFrame:
    return df.where(q(flag))


def only_day(df: DataFrame, flag: str = "isDay") -> DataFrame:
    return df.where(q(flag))

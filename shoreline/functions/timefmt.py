"""Time and value helpers.

Forecast times carry no zone, so they are ``TIMESTAMP_NTZ`` throughout.  The
helpers avoid ``date_trunc`` (which returns a zoned ``TIMESTAMP`` and depends
on the session time zone) and build truncations from date parts, which are
zone-free on ``TIMESTAMP_NTZ``.

Every helper exists in two forms: ``*_sql(name)`` returns a Spark SQL
expression string (for ``selectExpr`` / ``F.expr``; one JVM call per
expression, which keeps plan construction cheap), and the Column form, which
accepts a column name or a ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the wire format of every time field (``yyyy-MM-dd'T'HH:mm``).
WIRE_FORMAT = "yyyy-MM-dd'T'HH:mm"
WIRE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}$"
_WIRE_SQL = "'yyyy-MM-dd\\'T\\'HH:mm'"
_END_SQL = "'yyyy-MM-dd\\'T\\'HH\\':59\\''"


def q(name: str) -> str:
    """Quote a column name for a SQL expression."""
    return name if name.startswith("`") else "`" + name.replace("`", "``") + "`"


# ------------------------------------------------------------------ SQL forms

def hour_floor_sql(c: str) -> str:
    return f"make_timestamp_ntz(year({c}), month({c}), day({c}), hour({c}), 0, 0)"


def day_of_sql(c: str) -> str:
    return f"to_date({c})"


def day_start_sql(c: str) -> str:
    return f"CAST(to_date({c}) AS TIMESTAMP_NTZ)"


def plus_minutes_sql(c: str, minutes: str) -> str:
    return f"{c} + make_dt_interval(0, 0, {minutes}, 0)"


def plus_hours_sql(c: str, hours: str | int = 1) -> str:
    return f"{c} + make_dt_interval(0, {hours})"


def period_end_sql(c: str) -> str:
    return plus_minutes_sql(hour_floor_sql(c), "59")


def parse_wire_sql(c: str) -> str:
    """NULL for text that is not a wire time (a malformed record must not stop a job)."""
    return f"CASE WHEN {c} RLIKE '{WIRE_PATTERN}' THEN try_cast({c} AS TIMESTAMP_NTZ) END"


def wire_time_sql(c: str) -> str:
    return f"date_format({c}, {_WIRE_SQL})"


def wire_period_end_sql(c: str) -> str:
    return f"date_format({c}, {_END_SQL})"


def wire_date_sql(c: str) -> str:
    return f"date_format({c}, 'yyyy-MM-dd')"


# ------------------------------------------------------------------ Column forms

def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hour_floor(col: Column | str) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour, zone-free."""
    if isinstance(col, str):
        return F.expr(hour_floor_sql(q(col)))
    c = col
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                F.lit(0), F.lit(0))


def day_of(col: Column | str) -> Column:
    """Calendar day (DATE) of a TIMESTAMP_NTZ — the text before ``T`` on the wire."""
    return F.expr(day_of_sql(q(col))) if isinstance(col, str) else F.to_date(col)


def day_start(col: Column | str) -> Column:
    """Midnight (TIMESTAMP_NTZ) of the day of ``col``."""
    if isinstance(col, str):
        return F.expr(day_start_sql(q(col)))
    return F.to_date(col).cast("timestamp_ntz")


def plus_minutes(col: Column | str, minutes: Column | int) -> Column:
    if isinstance(col, str) and isinstance(minutes, int):
        return F.expr(plus_minutes_sql(q(col), str(minutes)))
    m = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return _c(col) + F.make_dt_interval(F.lit(0), F.lit(0), m, F.lit(0))


def plus_hours(col: Column | str, hours: int = 1) -> Column:
    if isinstance(col, str):
        return F.expr(plus_hours_sql(q(col), hours))
    return col + F.make_dt_interval(F.lit(0), F.lit(hours))


def period_end(col: Column | str) -> Column:
    """End of a period whose last hour is ``col``: the hour part plus 59 minutes."""
    if isinstance(col, str):
        return F.expr(period_end_sql(q(col)))
    return plus_minutes(hour_floor(col), 59)


def parse_wire(col: Column | str) -> Column:
    """Parse ``yyyy-MM-dd'T'HH:mm`` text into TIMESTAMP_NTZ (NULL if malformed)."""
    if isinstance(col, str):
        return F.expr(parse_wire_sql(q(col)))
    return F.when(col.rlike(WIRE_PATTERN), col.try_cast("timestamp_ntz"))


def wire_time(col: Column | str) -> Column:
    """Render a TIMESTAMP_NTZ in the wire format."""
    if isinstance(col, str):
        return F.expr(wire_time_sql(q(col)))
    return F.date_format(col, WIRE_FORMAT)


def wire_period_end(col: Column | str) -> Column:
    """Wire form of a period end: hour part of ``col`` followed by ``:59``."""
    if isinstance(col, str):
        return F.expr(wire_period_end_sql(q(col)))
    return F.date_format(col, "yyyy-MM-dd'T'HH':59'")


def wire_date(col: Column | str) -> Column:
    return F.expr(wire_date_sql(q(col))) if isinstance(col, str) else F.date_format(col, "yyyy-MM-dd")


def tolerant_double(col: Column | str) -> Column:
    """Numeric read that never fails: non-numeric text becomes 0.0, NULL stays NULL."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.coalesce(c.try_cast("double"), F.lit(0.0)))

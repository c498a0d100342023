"""Column helpers.  All are built-in Spark expressions (codegen, no Python)."""

from shoreline.functions.timefmt import (  # noqa: F401
    WIRE_FORMAT,
    day_of,
    day_of_sql,
    day_start,
    day_start_sql,
    hour_floor,
    hour_floor_sql,
    parse_wire,
    parse_wire_sql,
    period_end,
    period_end_sql,
    plus_hours,
    plus_hours_sql,
    plus_minutes,
    plus_minutes_sql,
    q,
    tolerant_double,
    wire_date,
    wire_date_sql,
    wire_period_end,
    wire_period_end_sql,
    wire_time,
    wire_time_sql,
)

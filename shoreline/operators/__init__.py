"""DataFrame -> DataFrame building blocks with column names as parameters."""

from shoreline.operators.joins import fk_join, latest_join, tag_sources  # noqa: F401
from shoreline.operators.latest import latest_per_key  # noqa: F401
from shoreline.operators.periods import (  # noqa: F401
    group_hours,
    merge_periods,
    periods_of,
)
from shoreline.operators.rules import (  # noqa: F401
    drop_incomplete,
    only_day,
    only_good,
    with_day_flag,
    with_good_flag,
)

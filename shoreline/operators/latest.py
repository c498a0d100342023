"""Latest value per key (a changelog collapsed to a table).

``groupBy(keys).agg(max_by(v, off) ...)`` is used rather than
``row_number() over (partition by keys order by off desc)``: the aggregate is
combined map-side (partial ``max_by`` per input partition), so a hot key that
holds a third of all events is reduced to one row per map task before the
shuffle, while a window would ship and sort every version of that key in one
task.  With fixed-width value columns the buffer stays in ``HashAggregate``.

A newer NULL hides an older value (``max_by`` returns the value of the highest
``off`` even when it is NULL), so filters on values must run *after* this step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions import q


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    values: Sequence[str] | None = None,
    order: str = "off",
) -> DataFrame:
    """One row per key holding the values of the row with the highest ``order``.

    ``keys`` may contain expressions (e.g. ``day_of('hora').alias('dia')``).
    ``values`` defaults to every column that is neither a key nor the order column.
    The winning ``order`` value is returned as well.
    """
    plain_keys = {k for k in keys if isinstance(k, str)}
    if values is None:
        values = [c for c in df.columns if c not in plain_keys and c != order]
    o = q(order)
    aggs = [F.expr(f"max_by({q(v)}, {o}) AS {q(v)}") for v in values]
    aggs.append(F.expr(f"max({o}) AS {o}"))
    return df.groupBy(*keys).agg(*aggs)

"""Row-level change feed between two states of a keyed table.

``change_feed`` compares two states in one full outer join on the key: a key only in the
new state is an insert, only in the old one a delete, in both with other values an update;
rows that stay the same are not in the feed.  A row of the feed carries the key, ``op``
(``insert``, ``update``, ``delete``), ``before`` and ``after`` (the values as structs, NULL
where there is none), so a consumer can retract what it derived from ``before``.
``apply_feed`` takes a feed to the state it started from and gives the other one back.

Both states hold a key once.  NULL keys match NULL keys, and values are compared
null-safe.  Both operators shuffle on the key and nothing else; a hot key cannot arise
since a key is one row on either side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _same_key(a: str, b: str, keys: Sequence[str]):
    cond = F.col(f"{a}.{keys[0]}").eqNullSafe(F.col(f"{b}.{keys[0]}"))
    for k in keys[1:]:
        cond = cond & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return cond


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """keys + ``op``, ``before``, ``after``: what turns ``old`` into ``new``."""
    def side(df):
        return df.select(*keys, F.struct(*values).alias("row"))

    both = side(old).alias("o").join(side(new).alias("n"), _same_key("o", "n", keys), "full_outer")
    # a row that is there has a struct, even one of NULLs
    op = (F.when(F.col("o.row").isNull(), F.lit("insert")).when(F.col("n.row").isNull(), F.lit("delete"))
          .otherwise(F.lit("update")))
    return (both.where(~F.col("o.row").eqNullSafe(F.col("n.row")))
            .select(*[F.coalesce(f"n.{k}", f"o.{k}").alias(k) for k in keys], op.alias("op"),
                    F.col("o.row").alias("before"), F.col("n.row").alias("after")))


def apply_feed(old: DataFrame, feed: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The state that ``feed`` leads to from ``old``."""
    kept = old.select(*keys, *values).alias("o").join(feed.select(*keys).alias("f"), _same_key("o", "f", keys), "left_anti")
    return kept.unionByName(feed.where("op <> 'delete'").select(*keys, *[F.col(f"after.{v}").alias(v) for v in values]))

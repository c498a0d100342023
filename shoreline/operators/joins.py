"""Joins between latest-value tables.

``latest_join`` joins N changelogs that share a key *and* keeps only the latest
version of each side — the table-table inner join of a changelog system — in a
single aggregation: each source is tagged with its own offset column, the
sources are unioned (narrow, no shuffle) and one ``groupBy(key)`` takes the
``max_by`` of every value by its own source's offset.  A key is kept when every
required source has contributed a row.

Compared with N latest-per-key aggregates followed by N-1 joins this plan has
one exchange instead of N, no sort-merge join, partial aggregation for every
source, and it is the same plan in streaming ``update`` mode (Spark rejects
joins between two streaming aggregates there).

``fk_join`` is the many-to-one join on an extracted key (hour -> its day's sun
row).  The "one" side is an aggregate bounded by the number of distinct
(city, day) pairs; it is not broadcast on a static guess.  Adaptive execution
measures the materialised side and turns the join into a broadcast join only
when the measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``;
beyond that it stays a shuffle join on (city, day) whose partitioning the
following per-day grouping reuses.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions import q


def _off(name: str) -> str:
    return f"_off_{name}"


def tag_sources(
    sources: Mapping[str, tuple[DataFrame, Sequence[str]]],
    keys: Sequence[str | Column],
    order: str = "off",
) -> DataFrame:
    """Union the sources, each projected to keys + its values + its own offset column."""
    tagged = None
    for name, (df, values) in sources.items():
        if all(isinstance(k, str) for k in keys):
            part = df.selectExpr(*[q(k) for k in keys], f"{q(order)} AS {q(_off(name))}",
                                 *[q(v) for v in values])
        else:
            part = df.select(*keys, F.col(order).alias(_off(name)), *values)
        tagged = part if tagged is None else tagged.unionByName(part, allowMissingColumns=True)
    if tagged is None:
        raise ValueError("latest_join needs at least one source")
    return tagged


def latest_join(
    sources: Mapping[str, tuple[DataFrame, Sequence[str]]],
    keys: Sequence[str | Column],
    order: str = "off",
    required: Sequence[str] | None = None,
    keep_offsets: bool = False,
) -> DataFrame:
    """Inner join of the latest version of each source on ``keys``.

    ``sources`` maps a source name to ``(frame, value_columns)``; value column
    names must be distinct across sources.  ``required`` lists the sources a key
    must appear in (default: all — an inner join).  Keys are given as column
    names; derive expression keys with ``withColumn`` before calling.
    """
    if any(not isinstance(k, str) for k in keys):
        raise ValueError("latest_join keys must be column names")
    tagged = tag_sources(sources, keys, order)
    return latest_join_tagged(tagged, {n: v for n, (_, v) in sources.items()}, keys,
                              required, keep_offsets)


def latest_join_tagged(
    tagged: DataFrame,
    values: Mapping[str, Sequence[str]],
    keys: Sequence[str],
    required: Sequence[str] | None = None,
    keep_offsets: bool = False,
) -> DataFrame:
    """``latest_join`` over an already tagged frame: for each source name ``n`` the
    frame carries ``_off_n`` (NULL where the row is not an event of ``n``) and the
    source's value columns.  Several logs that live in one physical table can be
    tagged in a single projection and joined without scanning the table once per log."""
    aggs = []
    for name, cols in values.items():
        o = q(_off(name))
        aggs += [F.expr(f"max_by({q(v)}, {o}) AS {q(v)}") for v in cols]
        aggs.append(F.expr(f"max({o}) AS {o}"))
    joined = tagged.groupBy(*keys).agg(*aggs)
    need = list(required) if required is not None else list(values)
    if need:
        joined = joined.where(" AND ".join(f"{q(_off(n))} IS NOT NULL" for n in need))
    if keep_offsets:
        return joined.withColumnsRenamed({_off(n): f"off_{n}" for n in values})
    return joined.drop(*[_off(n) for n in values])


def fk_join(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
) -> DataFrame:
    """Inner many-to-one join on ``keys`` (each row of ``many`` meets at most one row)."""
    return many.join(one, list(keys), "inner")

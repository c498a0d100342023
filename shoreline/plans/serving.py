"""Served tables: stage results written once, read by many views.

Recomputing the chain from the raw logs for every read view repeats the only
input-proportional work (the scans and the first aggregation) per request.
``materialize`` writes a stage result below the shared folder
(``spark.checkpoint.dir``), which also cuts its lineage, laid out for the
views that read it:

* directory-partitioned by day (``dia``), so day and week views prune whole
  directories (``PartitionFilters`` in the scan);
* range-partitioned and sorted by (dia, local) before the write, so every file
  covers a narrow city range and a city filter skips row groups by their
  statistics.  The range shuffle balances files by size; no single task gets a
  whole day, whatever the number of cities.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from shoreline.session import ensure_checkpoint_dir, shared_dir
from shoreline.sources.files import Files


def materialize(spark: SparkSession, df: DataFrame, name: str,
                partition_by: Sequence[str] = ("dia",),
                cluster_by: Sequence[str] = ("local",)) -> DataFrame:
    """Write ``df`` as a served table and return a reader of it."""
    return spark.read.parquet(write_table(spark, df, name, partition_by, cluster_by))


def write_table(spark: SparkSession, df: DataFrame, name: str,
                partition_by: Sequence[str] = ("dia",),
                cluster_by: Sequence[str] = ("local",)) -> str:
    path = shared_dir(spark, "tables", name)
    keys = [*partition_by, *cluster_by]
    (df.repartitionByRange(*keys)
       .sortWithinPartitions(*keys)
       .write.mode("overwrite").partitionBy(*partition_by).parquet(path))
    return path


def _registry(spark: SparkSession) -> Files:
    return Files(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/shoreline/served")


def _state_of(spark: SparkSession, source: str) -> str:
    """What the source holds: names, sizes and times of its files."""
    files = Files(spark, source)
    path = files.path("")
    if not files.fs.exists(path):
        return source
    seen = sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in files.fs.listStatus(path))
    return json.dumps([source, seen])


def _entry(spark: SparkSession, source: str, name: str) -> str:
    return f"{name}-{hashlib.sha256(_state_of(spark, source).encode()).hexdigest()[:24]}"


def served(spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame],
           partition_by: Sequence[str] = ("dia",), cluster_by: Sequence[str] = ("local",)) -> DataFrame:
    """The served table ``name`` of ``source``: written on first use (or after ``refresh``,
    or where its folder is gone, or where the source's files have changed), only read
    afterwards, by this application and any other that shares the folder.  The entry that
    names the table's folder appears after the table is whole; of two applications that
    write it at once, both read the one whose entry came first."""
    entries, entry = _registry(spark), _entry(spark, source, name)
    for attempt in (0, 1):
        numbers = [int(n) for n in entries.names(entry) if n.isdigit()]
        if numbers and (path := entries.read(f"{entry}/{max(numbers)}")):
            try:
                return spark.read.parquet(path)
            except AnalysisException:
                pass
        if attempt == 0:
            path = write_table(spark, build(), name, partition_by, cluster_by)
            entries.write(f"{entry}/{max(numbers, default=-1) + 1}", path)
    return spark.read.parquet(path)


def refresh(spark: SparkSession, source: str, name: str) -> None:
    """Let the next read of a served table write it anew; readers of the old one keep
    theirs, since every write has a folder of its own."""
    entries, entry = _registry(spark), _entry(spark, source, name)
    numbers = [int(n) for n in entries.names(entry) if n.isdigit()]
    if numbers:
        entries.write(f"{entry}/{max(numbers) + 1}", "")

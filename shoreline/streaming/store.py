"""The stored table of a streaming stage: versions, the index of their days, a base.

Layout below the table's folder::

    version=<n>/dia=<d>/part-*     rows of micro-batch n, by day
    _days/<n>                      the days version n holds (JSON)
    _base/run=<id>/dia=<d>/part-*  compacted days; rows keep their version
    _current/<seq>                 {"through": n, "days": {d: id}} (JSON)

A version counts once its day list is written, which happens after its rows are, so
readers never see half a batch.  Readers take the newest pointer, the base folders of the
days they want, and the folders of the newer versions that hold these days: a read of one
day opens that day's folders alone and lists nothing else.

``compact`` merges the days that versions after the pointer touched, writes them to a new
base folder and then adds the next pointer, by a rename to a name that must not exist yet.
A crash before the rename leaves an unused folder; readers see the old pointer or the new
one, so nothing is lost or doubled.  Days no newer version touched keep their folder.
``vacuum`` deletes what no reader needs any more.  Versions are read by downstream
streams too, so it deletes only those that the caller says were consumed.

Pointers and day lists are small (days, not rows) and are read by the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.operators.latest import latest_per_key
from shoreline.sources.files import Files


def latest_rows(keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge rule: of every key the row of its highest version."""
    return lambda rows: latest_per_key(rows, list(keys), order="version")


def latest_groups(group: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge rule: of every group all rows of its highest version."""
    def merge(rows: DataFrame) -> DataFrame:
        newest = rows.groupBy(*group).agg(F.max("version").alias("_v"))
        return rows.join(newest, list(group)).where("version = _v").drop("_v").distinct()
    return merge


#: In a day list: the version's rows lie in its own folder.
WHOLE = ""


def _day(folder: str) -> str:
    return folder.partition("=")[2]


class StageTable:
    """A stage's stored table.  ``schema`` holds its columns with ``dia`` and ``version``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.files = Files(spark, path)

    # ------------------------------------------------------------- writing

    def commit(self, version: int) -> list[str]:
        """Publish a version whose rows are written: note the days it holds ("" where it is
        not written by day)."""
        names = self.files.names(f"version={version}")
        days = sorted(_day(n) for n in names if n.startswith("dia="))
        if not days and any(n.startswith("part-") for n in names):
            days = [WHOLE]
        self.files.write(f"_days/{version}", json.dumps(days), replace=True)
        return days

    def adopt(self) -> None:
        """Publish versions written before day lists were kept."""
        known = set(self.files.names("_days"))
        for n in self.files.names(""):
            if n.startswith("version=") and _day(n) not in known:
                self.commit(int(_day(n)))

    # ------------------------------------------------------------- reading

    def pointer(self) -> tuple[int, dict]:
        """(number of the newest pointer, its content)."""
        numbers = [int(n) for n in self.files.names("_current") if n.isdigit()]
        if not numbers:
            return -1, {"through": -1, "days": {}}
        return max(numbers), json.loads(self.files.read(f"_current/{max(numbers)}"))

    def versions(self, after: int = -1) -> dict[int, list[str]]:
        """The days of every published version after ``after``."""
        numbers = sorted(int(n) for n in self.files.names("_days") if n.isdigit())
        return {n: json.loads(self.files.read(f"_days/{n}")) for n in numbers if n > after}

    def folders(self, days: Iterable | None = None) -> tuple[list[str], list[str]]:
        """(base folders, version folders) that hold rows of ``days``, or of all days."""
        _, now = self.pointer()
        wanted = None if days is None else {str(d) for d in days}
        base = [f"{self.path}/_base/run={run}/dia={d}" for d, run in sorted(now["days"].items())
                if wanted is None or d in wanted]
        new = [f"{self.path}/version={n}" + (f"/dia={d}" if d != WHOLE else "")
               for n, held in self.versions(now["through"]).items() for d in held
               if wanted is None or d == WHOLE or d in wanted]
        return base, new

    def read(self, days: Iterable | None = None) -> DataFrame:
        """Rows of all versions, older ones merged away where they were compacted; with
        ``days`` those days alone."""
        days = None if days is None else sorted(set(days))
        base, new = self.folders(days)
        frames = []
        if base:
            frames.append(self.spark.read.schema(self._base_schema()).option("basePath", f"{self.path}/_base")
                          .parquet(*base))
        if new:
            frames.append(self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*new))
        names = [f.name for f in self.schema]
        if not frames:
            return self.spark.createDataFrame([], self.schema)
        if days is not None:
            frames = [f.where(F.col("dia").isin(days)) for f in frames]
        out = frames[0].select(*names)
        for f in frames[1:]:
            out = out.unionByName(f.select(*names))
        return out

    def as_of(self, version: int, days: Iterable | None = None) -> DataFrame:
        """The rows up to ``version``, which must not be older than the base."""
        if version < self.pointer()[1]["through"]:
            raise ValueError(f"version {version} was merged into the base")
        return self.read(days).where(F.col("version") <= version)

    def _base_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("run", T.StringType())])

    # ------------------------------------------------------------- upkeep

    def compact(self, merge: Callable[[DataFrame], DataFrame]) -> dict:
        """Merge every day that a newer version touched into the base; returns the pointer in
        force afterwards."""
        number, now = self.pointer()
        newer = self.versions(now["through"])
        if not newer:
            return now
        if any(WHOLE in held for held in newer.values()):
            raise ValueError("versions that are not written by day cannot be compacted")
        touched = sorted({d for held in newer.values() for d in held})
        run = uuid.uuid4().hex
        days = dict(now["days"])
        if touched:
            rows = merge(self._of_days(touched))
            out = (rows.select(*[f.name for f in self.schema]).repartitionByRange("dia", "local")
                   .sortWithinPartitions("dia", "local"))
            out.write.partitionBy("dia").parquet(f"{self.path}/_base/run={run}")
            held = {_day(n) for n in self.files.names(f"_base/run={run}") if n.startswith("dia=")}
            days = {d: r for d, r in days.items() if d not in touched} | {d: run for d in held}
        after = {"through": max(newer), "days": days}
        if self.files.write(f"_current/{number + 1}", json.dumps(after)):
            return after
        return self.pointer()[1]                        # another compaction came first

    def _of_days(self, names: list[str]) -> DataFrame:
        """``read`` by day names as they stand in folders (a NULL day has one as well)."""
        base, new = self.folders(names)
        frames = []
        if base:
            frames.append(self.spark.read.schema(self._base_schema()).option("basePath", f"{self.path}/_base")
                          .parquet(*base).drop("run"))
        if new:
            frames.append(self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*new))
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def vacuum(self, consumed: int = -1, pointers: int = 1) -> None:
        """Delete the versions up to ``consumed`` that are in the base, and what none of the
        newest ``pointers`` pointers uses.  Readers that hold an older pointer must be done,
        and no compaction may be under way."""
        numbers = sorted(int(n) for n in self.files.names("_current") if n.isdigit())
        if not numbers:
            return
        kept = [json.loads(self.files.read(f"_current/{n}")) for n in numbers[-pointers:]]
        used = {run for p in kept for run in p["days"].values()}
        for n in self.files.names("_base"):
            if _day(n) not in used:
                self.files.delete(f"_base/{n}")
        through = min(consumed, *(p["through"] for p in kept))
        for n in [int(n) for n in self.files.names("_days") if n.isdigit()]:
            if n <= through:
                self.files.delete(f"version={n}")
                self.files.delete(f"_days/{n}")
        for n in numbers[:-pointers]:
            self.files.delete(f"_current/{n}")

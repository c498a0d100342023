"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.session import shared_dir

#: Labelled rows whose fold is 0 are held out: no classifier ever sees them.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts the
    lineage, survives the loss of executors, and forgets the partitioning, so a
    join on it gets exchanges of its own that adaptive execution can split."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}_{uuid.uuid4().hex[:6]}"
    return name


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; a null id counts as empty text (0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    up = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.when(F.octet_length(t) == F.char_length(t), F.lower(t))
            .otherwise(F.translate(t, up, up.lower())))


def worker_cache(key, build, keep: int = 6):
    """``build()`` once per Python worker process and key; the oldest entries go."""
    name = "_shoreline_worker_cache"
    mod = sys.modules.get(name)
    if mod is None:
        mod = sys.modules[name] = types.ModuleType(name)
        mod.store = {}
    if key not in mod.store:
        while len(mod.store) >= keep:
            mod.store.pop(next(iter(mod.store)))
        mod.store[key] = build()
    return mod.store[key]


class Shipped:
    """A broadcast object of this package, pickled by value like the functions."""

    def __init__(self, spark: SparkSession, item):
        self.data = spark.sparkContext.broadcast(cloudpickle.dumps(item))
        self.item = None

    @property
    def value(self):
        if self.item is None:
            self.item = cloudpickle.loads(self.data.value)
        return self.item


def drop_rows(docs: DataFrame, keys: DataFrame, on: dict[str, Column],
              how: str = "left_anti") -> DataFrame:
    """``docs`` without the rows whose key is in ``keys`` (null matches null), or
    with ``how="left_semi"`` those rows only.

    ``on``: key column of ``keys`` -> the expression over ``docs`` it equals.
    """
    names = {k: fresh(docs, f"drop_{k}") for k in on}
    small = keys.select(*[F.col(k).alias(n) for k, n in names.items()]).hint("shuffle_hash")
    cond = None
    for k, expr in on.items():
        c = expr.eqNullSafe(F.col(names[k]))
        cond = c if cond is None else cond & c
    return docs.join(small, cond, how)


def labelled(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label, fold) of the labelled rows outside the held-out fold; a
    repeated id counts once, with its largest label."""
    return (labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label"))
            .where("doc_id IS NOT NULL AND label IN (0, 1)")
            .groupBy("doc_id").agg(F.max("label").alias("label"))
            .withColumn("fold", fold(F.col("doc_id"))).where("fold <> 0"))


def sample_ids(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """The ``n`` rows with the smallest hash of their id, as a small local table."""
    got = (rows.withColumn("h", F.xxhash64("doc_id", F.lit(seed))).orderBy("h", "doc_id")
           .limit(n).drop("h"))
    return rows.sparkSession.createDataFrame(got.collect(), got.schema)


# --- logistic calibration on a bounded sample ---------------------------------------


class Logistic:
    """Ridge logistic regression on standardised features, fitted by damped Newton
    steps.  Without rows of both classes it answers the smoothed base rate."""

    def __init__(self, x, y, ridge: float = 1.0, steps: int = 60):
        y = np.asarray(y, float)
        self.rate = (y.sum() + 0.5) / (len(y) + 1.0)
        self.w = None
        if len(np.unique(y)) < 2:
            return
        x = np.asarray(x, float).reshape(len(y), -1)
        self.mu, self.sd = x.mean(0), x.std(0) + 1e-9
        z = self._design(x)
        w = np.zeros(z.shape[1])
        w[-1] = np.log(self.rate / (1 - self.rate))
        pen = np.full(len(w), ridge)
        pen[-1] = 1e-6

        def loss(v):
            a = z @ v
            return np.sum(np.logaddexp(0, a) - y * a) + 0.5 * np.sum(pen * v * v)

        best = loss(w)
        for _ in range(steps):
            p = self._sigmoid(z @ w)
            grad = z.T @ (p - y) + pen * w
            hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(pen)
            step = np.linalg.solve(hess, grad)
            size = 1.0
            while size > 1e-6 and loss(w - size * step) > best:
                size /= 2
            new = loss(w - size * step)
            if not new < best - 1e-9:
                break
            w, best = w - size * step, new
        self.w = w

    @staticmethod
    def _sigmoid(a):
        return 1.0 / (1.0 + np.exp(-np.clip(a, -35, 35)))

    def _design(self, x):
        z = np.clip((x - self.mu) / self.sd, -8, 8)
        return np.hstack([z, np.ones((len(z), 1))])

    def predict(self, x):
        x = np.asarray(x, float)
        if self.w is None:
            return np.full(len(x), self.rate)
        return self._sigmoid(self._design(x) @ self.w)

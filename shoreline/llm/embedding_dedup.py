"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are normalised, and equal ones merged first, so a group of copies costs one
row.  Cosine ``c`` of unit vectors is Euclidean distance sqrt(2 - 2c).  Each of L tables
hashes a vector to k quantised Gaussian projections, floor((a.x + b) / w); the k numbers
make the bucket.  k grows with the logarithm of the number of distinct vectors, so that
unrelated vectors rarely share a bucket, and L follows from k so that a pair right at
the threshold shares one in some table with probability ``RECALL``.

Buckets with a single vector are dropped before any vector moves; only the others are
joined with their vectors.  In a bucket every pair is compared exactly, in double
precision; the members of a large bucket are dealt into blocks of about ``SHARD_ROWS``,
fewer where vectors are long, and each pair of blocks is a tile of its own, so a task
holds two blocks at most and the vectors shuffled are m * m / ``SHARD_ROWS`` for m members.  A pair counts in the
first table whose bucket it shares, so each link counts once without being written: a
task hands on, per vector, the number of its links (each weighted by the other's
copies), and a spanning forest of the links for the components.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing; vectors of different lengths do not link, those of each length are
hashed and compared among themselves; finite vectors of any size count; repeated rows are
copies of one vector and link with each other; a null id is reported like any other and
names a component only where all its members lack one; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shipped, materialise
from .components import connected_components, forest

THRESHOLD = 0.95
WIDTH = 2.0
RECALL = 0.998
SEED = 6
#: Rows and bytes of one block of a bucket, about, whichever is less; a task compares two
#: blocks at a time.
SHARD_ROWS = 4096
SHARD_BYTES = 32 << 20
_BLOCK = 2048
_PRODUCTS = 1 << 21


def collision(distance: float, width: float) -> float:
    """Probability that one quantised projection agrees at a distance."""
    r = width / distance
    return (math.erf(r / math.sqrt(2))
            - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2)))


def plan(n: int, threshold: float = THRESHOLD, width: float = WIDTH, recall: float = RECALL) -> tuple[int, int]:
    """(projections per table, tables) for ``n`` distinct vectors."""
    near, far = collision(math.sqrt(2 - 2 * threshold), width), collision(math.sqrt(2), width)
    k = max(1, math.ceil(math.log(max(n, 2)) / -math.log(far)) + 2)
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near ** k)))


class Hasher:
    """Quantised projections for vectors of any length: each length has its own, drawn from
    the seed, and its own buckets."""

    def __init__(self, k: int, tables: int, width: float, seed: int = SEED):
        self.k, self.tables, self.width, self.seed = k, tables, width, seed
        rng = np.random.default_rng(seed)
        self.mix = rng.integers(-(1 << 62), 1 << 62, k, dtype=np.int64) | 1
        self.drawn = {}

    def _draws(self, dim: int):
        if dim not in self.drawn:
            if len(self.drawn) > 8:
                self.drawn.clear()
            rng = np.random.default_rng((self.seed, dim))
            self.drawn[dim] = (rng.standard_normal((dim, self.k * self.tables)), rng.uniform(0, self.width, self.k * self.tables),
                               rng.integers(-(1 << 62), 1 << 62, self.tables, dtype=np.int64))
        return self.drawn[dim]

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """One 64-bit bucket per vector and table (n x L)."""
        a, b, salt = self._draws(x.shape[1])
        q = np.floor((x @ a + b) / self.width).astype(np.int64)
        q = q.reshape(len(x), self.tables, self.k)
        with np.errstate(over="ignore"):
            h = (q * self.mix).sum(axis=2) + salt
            h ^= h >> 29
            h *= np.int64(-4658895280553007687)
            h ^= h >> 32
        return h


def _by_length(values: list[bytes]):
    """(positions, vectors) of each length."""
    size = np.array([len(v) for v in values])
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield at, np.frombuffer(b"".join(values[i] for i in at), "<f8").reshape(len(at), n // 8)


def _unit(batches):
    """(id, list) -> (id, unit vector as bytes or null)."""
    for b in batches:
        out = []
        for v in b.column(1).to_pylist():
            x = None
            if v and not any(c is None for c in v):
                x = np.asarray(v, "<f8")
                if np.isfinite(x).all() and x.any():
                    x = x / np.abs(x).max()       # its norm cannot overflow or vanish now
                    x = x / np.linalg.norm(x)
                else:
                    x = None
            out.append(x)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([None if x is None else x.tobytes() for x in out], pa.binary())], ["id", "unit"])


def _hash(hasher):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                for rows, x in _by_length(part.column(1).to_pylist()):
                    h = hasher.value.buckets(x)
                    v = np.repeat(ids[rows], h.shape[1])
                    size = np.full(len(v), x.shape[1] * 8)
                    yield pa.RecordBatch.from_arrays([pa.array(h.ravel()), pa.array(v), pa.array(size)],
                                                     ["bucket", "v", "bytes"])
    return run


def _compare(hasher, threshold: float):
    """(bucket, lo, hi, v, unit, n, left) sorted by tile (bucket, lo, hi) -> rows (a, b, links):
    b set: a forest edge; b null: links of vector a found here.  A tile holds the two
    blocks lo and hi of a bucket's members, or one where they are the same, and each pair
    of members is in one tile."""
    def one(rows, alone):
        v, unit, n, left = rows
        if len(v) < 2 or not alone and left.all():
            return
        order = np.argsort(v, kind="stable")
        v, n, left = v[order], n[order], left[order]
        x = np.stack([np.frombuffer(unit[i], "<f8") for i in order])
        bucket_of = {}

        def keys(i):
            if i not in bucket_of:
                bucket_of[i] = hasher.value.buckets(x[i:i + 1])[0]
            return bucket_of[i]

        mine, others = (np.arange(len(v)),) * 2 if alone else (np.flatnonzero(left), np.flatnonzero(~left))
        some = max(1, _PRODUCTS // x.shape[1])
        for at in range(0, len(mine), _BLOCK):
            q = mine[at:at + _BLOCK]
            for to in range(0, len(others), _BLOCK):
                r = others[to:to + _BLOCK]
                i, j = np.nonzero(x[q] @ x[r].T >= threshold - 1e-9)
                i, j = q[i], r[j]
                if alone:
                    ok = i < j
                    i, j = i[ok], j[ok]
                # products in one fixed order decide at the threshold, whatever the blocks
                ok = np.zeros(len(i), bool)
                for p in range(0, len(i), some):
                    ok[p:p + some] = (x[i[p:p + some]] * x[j[p:p + some]]).sum(axis=1) >= threshold
                yield i[ok], j[ok], v, n, keys

    def links(rows, bucket, alone):
        # a bucket is one length's, but for a rare collision of bucket numbers
        size = np.array([len(u) for u in rows[1]])
        for length in np.unique(size):
            same = size == length
            yield from same_length([x[same] for x in rows], bucket, alone)

    def same_length(rows, bucket, alone):
        for i, j, v, n, keys in one(rows, alone):
            if not len(i):
                continue
            need = np.unique(np.concatenate([i, j]))
            k = np.zeros((len(v), hasher.value.tables), np.int64) if len(v) <= 4 * len(need) else None
            if k is None:
                table = {int(a): keys(int(a)) for a in need}
                same = np.array([table[int(a)] == table[int(b)] for a, b in zip(i, j, strict=True)])
                first = np.array([table[int(a)][s.argmax()] for a, s in zip(i, same, strict=True)])
            else:
                for a in need:
                    k[a] = keys(int(a))
                first = np.empty(len(i), np.int64)
                for at in range(0, len(i), 20_000):
                    p = slice(at, at + 20_000)
                    same = k[i[p]] == k[j[p]]
                    first[p] = k[i[p]][np.arange(len(same)), same.argmax(axis=1)]
            own = first == bucket
            yield v, n, i[own], j[own]

    def run(batches):
        us, vs, held = [], [], 0

        def group(rows, bucket, alone):
            nonlocal held
            totals = {}
            for v, n, i, j in links(rows, bucket, alone):
                # the rows of one length share one array of numbers
                _, total = totals.setdefault(id(v), (v, np.zeros(len(v), np.int64)))
                np.add.at(total, i, n[j])
                np.add.at(total, j, n[i])
                u, w = forest(v[i], v[j]) if len(i) else (v[:0], v[:0])
                us.append(u)
                vs.append(w)
                held += len(u)
            for v, total in totals.values():
                at = np.flatnonzero(total)
                if len(at):
                    yield v[at], total[at]

        def out(a, b, links):
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], ["a", "b", "links"])

        def pieces():
            rest = None
            for b in batches:
                cols = [b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 3, 5, 6)]
                cols.insert(4, np.array(b.column(4).to_pylist() + [None], object)[:-1])
                if rest is not None:
                    cols = [np.concatenate(c) for c in zip(rest, cols, strict=True)]
                if not len(cols[0]):
                    continue
                new = np.zeros(len(cols[0]) - 1, bool)
                for key in cols[:3]:
                    new |= key[1:] != key[:-1]
                start = 0
                for c in np.flatnonzero(new) + 1:
                    yield cols[0][start], cols[1][start] == cols[2][start], [x[start:c] for x in cols[3:]]
                    start = c
                rest = [x[start:] for x in cols]
            if rest is not None and len(rest[0]):
                yield rest[0][0], rest[1][0] == rest[2][0], rest[3:]

        for bucket, alone, rows in pieces():
            for a, links_of in group(rows, bucket, alone):
                yield out(a, [None] * len(a), links_of)
            if held > 1_000_000:
                u, w = forest(np.concatenate(us), np.concatenate(vs))
                us[:], vs[:], held = [u], [w], 0
        if sum(map(len, us)):
            u, w = forest(np.concatenate(us), np.concatenate(vs))
            yield out(u, w, [None] * len(u))
    return run


def near_duplicate_groups(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                          threshold: float = THRESHOLD, width: float = WIDTH, recall: float = RECALL) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    spark = table.sparkSession
    id_type = table.schema[id_col].dataType.simpleString()
    rows = materialise(
        table.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("x"))
        .mapInArrow(_unit, f"id {id_type}, unit binary"), "units")
    # a distinct vector's number: its rank of creation, fixed once written
    distinct = materialise(
        rows.where("unit IS NOT NULL").groupBy("unit")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
        .withColumn("v", F.monotonically_increasing_id()), "distinct")
    size = distinct.count()
    k, tables = plan(size, threshold, width, recall)
    hasher = Shipped(spark, Hasher(k, tables, width))

    hashed = materialise(distinct.select("v", "unit").mapInArrow(_hash(hasher), "bucket long, v long, bytes long"),
                         "buckets")
    full = materialise(
        hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.sum("bytes").alias("bytes"))
        .where("m > 1").withColumn("shards", F.greatest(F.ceil(F.col("m") / SHARD_ROWS),
                                                        F.ceil(F.col("bytes") / SHARD_BYTES)).cast("int")), "full")
    members = hashed.select("bucket", "v").join(full.select("bucket", "shards"), "bucket")
    members = members.join(distinct.select("v", "unit", "n"), "v")
    own = F.pmod(F.xxhash64("v"), F.col("shards")).cast("int")
    dealt = (members.select("bucket", F.explode(F.expr("sequence(0, shards - 1)")).alias("other"), "v", "unit", "n",
                            own.alias("own"))
             .select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "v", "unit",
                     "n", (F.col("own") <= F.col("other")).alias("left"))
             .repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi"))
    found = materialise(dealt.mapInArrow(_compare(hasher, threshold), "a long, b long, links long"), "found")

    linked = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    comp = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    known = (distinct.join(linked, distinct.v == linked.a, "left").drop("a")
             .join(comp, F.col("v") == F.col("node"), "left")
             .select("v", "unit", "low", F.coalesce("root", "v").alias("root"),
                     (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    known = materialise(known, "known")
    low = materialise(known.groupBy("root").agg(F.min("low").alias("component_id")), "low")
    known = materialise(known.join(low, "root").select("unit", "n_links", "component_id"), "known")
    out = rows.join(known, "unit", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))

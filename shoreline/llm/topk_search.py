"""Exact top-k inner products by a Voronoi kNN join.

Queries are grouped by their nearest pivot and, within a cell, by rings of the distance
to it, so that a few far queries do not widen the cell of many near ones.  A cell's
radius R bounds every score in it: for a query q of the cell of pivot p and any vector x,
p.x - R|x| <= q.x <= min(p.x + R|x|, Q|x|), with Q the largest norm of the cell's queries.

One pass over the data summarises it by the same pivots: of every data group its size,
radius and largest norm, and for every query cell the k + 1 largest lower bounds, whose
least is a score that each of its queries reaches in any case (one of them may be the
query itself).  A data group whose summary cannot reach a cell's score is left out whole;
of the others only vectors whose own upper bound reaches it are sent.  Cells are put
together into chunks of queries, and cells of more queries are split, so a vector is sent
once for a chunk of up to ``CHUNK`` queries; where the bounds leave nothing out (vectors
without neighbours) that is a block-wise search with rows / ``CHUNK`` copies.

A chunk's vectors are dealt over shards by the size of the groups that may reach it; a
task keeps k candidates per query, and the k best over all shards are the result.  Copies
of one vector are dealt like any other rows, so no cell or group sits in one task.

Components become floor(scale * x), x as double; scores are exact integers, by doubles
where no sum can pass 2^53 and by Python's integers elsewhere, and clamped to the range of
a long.  Bounds are widened by a relative 1e-9 against rounding.

Pivots: at most ``PIVOTS`` queries, in the order of their ids' hash, fewer where vectors
are very long.  Queries of a length that no pivot has, and such of infinite radius, get
cells without a bound.

Defined cases: vectors that are null or hold null or non-finite components take no part;
vectors of different lengths have no score; empty vectors score 0 with each other; ties
go to the smaller id, null ids last; a row never matches itself, but repeated rows match
each other, and a repeated query row is a query of its own; a null id is no query; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shipped, materialise

K = 10
SCALE = 1024
PIVOTS = 256
#: Queries of a chunk, the most a task holds, and data rows of a shard, about.
CHUNK = 4096
SHARD_ROWS = 1 << 16
RINGS = 8
#: Cells of queries whose length no pivot has.
ODD = 16
_PIVOT_CELLS = 4_000_000
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def _integers(scale: int):
    """(id, list) -> (id, integers as bytes; huge ones as text)."""
    def run(batches):
        for b in batches:
            vecs, huge = [], []
            for v in b.column(1).to_pylist():
                x = None if v is None or any(c is None for c in v) else np.asarray(v, "<f8")
                if x is None or not np.isfinite(x).all():
                    vecs.append(None)
                    huge.append(None)
                    continue
                with np.errstate(over="ignore"):
                    y = np.floor(x * scale)
                far = not (np.abs(y) < _EXACT).all()
                # a double of 2^53 or more is an integer: scaling it is exact in integers
                huge.append(" ".join(str(int(c) * scale if abs(c) >= _EXACT else int(np.floor(c * scale))) for c in x) if far else None)
                vecs.append(y.tobytes())
            keep = pa.array([v is not None for v in vecs])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(vecs, pa.binary()), pa.array(huge, pa.string())], ["id", "v", "huge"]).filter(keep)
    return run


def _matrix(column) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{length: (positions, rows)} of a column of vectors."""
    values = column.to_pylist()
    size = np.array([len(v) // 8 for v in values])
    return {int(d): (at := np.flatnonzero(size == d),
                     np.frombuffer(b"".join(values[i] for i in at), "<f8").reshape(len(at), int(d)))
            for d in np.unique(size)}


class Cells:
    """Pivots by vector length, and of every query cell its radius, largest norm and score."""

    def __init__(self, pivots: list[bytes]):
        self.pivots = {}
        for p in sorted(set(pivots)):
            self.pivots.setdefault(len(p) // 8, []).append(np.frombuffer(p, "<f8"))
        self.first, at = {}, 0
        for d, rows in sorted(self.pivots.items()):
            self.pivots[d] = np.stack(rows)
            self.first[d] = at
            at += len(rows)
        self.groups = at
        self.n = at * RINGS + ODD

    def nearest(self, x: np.ndarray):
        """(pivot, distance, products with all pivots of this length, norms)."""
        p = self.pivots[x.shape[1]]
        with np.errstate(over="ignore", invalid="ignore"):
            prod = x @ p.T
            norm = np.sqrt((x * x).sum(axis=1))
            gap = np.maximum((p * p).sum(axis=1) - 2 * prod + (norm * norm)[:, None], 0)
            at = np.where(np.isfinite(gap), gap, np.inf).argmin(axis=1)
            dist = np.sqrt(((x - p[at]) ** 2).sum(axis=1))
        return at, dist, prod, norm

    def cell(self, x: np.ndarray):
        """(cell, distance to its pivot, norm) of queries of one length."""
        d = x.shape[1]
        if d not in self.pivots:
            with np.errstate(over="ignore"):
                norm = np.sqrt((x * x).sum(axis=1))
            return np.full(len(x), self.groups * RINGS + d % ODD), np.full(len(x), np.inf), norm
        at, dist, _, norm = self.nearest(x)
        with np.errstate(divide="ignore", invalid="ignore"):
            ring = np.floor(np.log2(np.maximum(norm, 1) / np.maximum(dist, 1e-9)) * 2)
        ring = RINGS - 1 - np.clip(np.nan_to_num(ring, nan=0, posinf=RINGS - 1), 0, RINGS - 1).astype(int)
        return (self.first[d] + at) * RINGS + ring, dist, norm

    def settle(self, radius, biggest):
        """Radius and largest norm per cell; cells without queries have radius -1."""
        self.radius, self.biggest = radius, biggest
        self.used = {d: np.array([(self.first[d] + i) * RINGS + r for i in range(len(p)) for r in range(RINGS)
                                  if radius[(self.first[d] + i) * RINGS + r] >= 0], int)
                     for d, p in self.pivots.items()}
        self.odd = np.array([c for c in range(self.groups * RINGS, self.n) if radius[c] >= 0], int)

    def bounds(self, x: np.ndarray):
        """(query cells of this length, lower, upper bounds of scores, data group, distance, norm)."""
        d = x.shape[1]
        cells = self.used[d]
        at, dist, prod, norm = self.nearest(x)
        with np.errstate(over="ignore", invalid="ignore"):
            mid = prod[:, cells // RINGS - self.first[d]]
            spread = norm[:, None] * self.radius[cells]
            slack = 1e-9 * (np.abs(mid) + spread + 1)
            high = np.minimum(mid + spread, norm[:, None] * self.biggest[cells]) + slack
            low = mid - spread - slack
        return cells, np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high), \
            self.first[d] + at, dist, norm


def _assign(cells):
    def run(batches):
        for b in batches:
            cell, dist, norm = np.zeros(b.num_rows, int), np.zeros(b.num_rows), np.zeros(b.num_rows)
            for at, x in _matrix(b.column(2)).values():
                cell[at], dist[at], norm[at] = cells.value.cell(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), b.column(3), pa.array(cell, pa.int32()), pa.array(dist), pa.array(norm)],
                ["uid", "id", "v", "huge", "cell", "dist", "norm"])
    return run


def _summarise(cells, k: int):
    """Vectors -> (kind 0: cell, bound), the k + 1 best lower bounds of a task, and
    (kind 1: data group, rows, radius, largest norm)."""
    def run(batches):
        c = cells.value
        best = {}
        size, radius, biggest = np.zeros(c.groups, int), np.zeros(c.groups), np.zeros(c.groups)
        for b in batches:
            for d, (_, x) in _matrix(b.column(0)).items():
                if d not in c.pivots:
                    continue
                used, low, _, group, dist, norm = c.bounds(x)
                size += np.bincount(group, minlength=c.groups)
                np.maximum.at(radius, group, np.nan_to_num(dist, nan=np.inf))
                np.maximum.at(biggest, group, np.nan_to_num(norm, nan=np.inf))
                if len(used):
                    old = best.get(d, np.full((0, len(used)), -np.inf))
                    both = np.concatenate([old, low])
                    if len(both) > k + 1:
                        both = -np.partition(-both, k, axis=0)[:k + 1]
                    best[d] = both
        for d, values in best.items():
            used = c.used[d]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(values.size, np.int32)), pa.array(np.tile(used, len(values)).astype(np.int32)),
                 pa.array(values.ravel()), pa.array(np.zeros(values.size)), pa.array(np.zeros(values.size, np.int64))],
                ["kind", "cell", "a", "b", "n"])
        on = np.flatnonzero(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(on), np.int32)), pa.array(on.astype(np.int32)), pa.array(radius[on]),
             pa.array(biggest[on]), pa.array(size[on])], ["kind", "cell", "a", "b", "n"])
    return run


class Routes:
    """Which chunks a vector must be sent to, and over how many shards each is dealt."""

    def __init__(self, cells: Cells, score: np.ndarray, count: np.ndarray, groups, odd_rows: int, chunk: int, shard_rows: int):
        self.cells, self.score = cells, score
        self.parts = np.maximum(1, -(-count // chunk))
        self.chunk_of, room, at = [[] for _ in range(cells.n)], 0, -1
        order = [c for c in range(cells.n) if count[c]]
        for c in sorted(order, key=lambda c: (self._length(c), -score[c], c)):
            share = -(-count[c] // self.parts[c])
            for _ in range(self.parts[c]):
                if share > room:
                    at, room = at + 1, chunk
                room -= share
                self.chunk_of[c].append(at)
        self.chunks = at + 1
        # data groups that may reach a cell, by their summaries
        self.open = {}
        rows = np.zeros(max(1, self.chunks))
        for d, used in cells.used.items():
            first, p = cells.first[d], cells.pivots[d]
            with np.errstate(over="ignore", invalid="ignore"):
                near, norms = p @ p.T, np.sqrt((p * p).sum(axis=1))
            ok = np.zeros((len(p), len(used)), bool)
            for g in range(len(p)):
                n, radius, biggest = groups.get(first + g, (0, 0.0, 0.0))
                if not n:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    i = used // RINGS - first
                    high = np.minimum(near[i, g] + norms[i] * radius + cells.radius[used] * biggest, cells.biggest[used] * biggest)
                    ok[g] = ~(high * (1 + 1e-9) + 1e-6 * np.abs(high) + 1 < score[used])
                for c in {x for j in used[ok[g]] for x in self.chunk_of[j]}:
                    rows[c] += n
            self.open[d] = ok
        for c in cells.odd:
            for x in self.chunk_of[c]:
                rows[x] += odd_rows
        self.shards = np.maximum(1, np.ceil(rows / shard_rows)).astype(int)
        # chunk membership per used cell
        self.member = {}
        for d, used in cells.used.items():
            m = np.zeros((len(used), max(1, self.chunks)), bool)
            for j, c in enumerate(used):
                m[j, self.chunk_of[c]] = True
            self.member[d] = m

    def _length(self, cell: int):
        if cell >= self.cells.groups * RINGS:
            return -1
        return max(d for d, f in self.cells.first.items() if f <= cell // RINGS)

    def home(self, cell: np.ndarray, uid: np.ndarray) -> np.ndarray:
        return np.array([self.chunk_of[c][int(u) % len(self.chunk_of[c])] for c, u in zip(cell, uid, strict=True)], int)

    def wanted(self, x: np.ndarray) -> np.ndarray:
        """rows x chunks: where vectors of one length must go."""
        d = x.shape[1]
        out = np.zeros((len(x), max(1, self.chunks)), bool)
        if d in self.cells.pivots and len(self.cells.used[d]):
            used, _, high, group, _, _ = self.cells.bounds(x)
            need = self.open[d][group - self.cells.first[d]] & (high >= self.score[used])
            out |= (need.astype(np.float32) @ self.member[d].astype(np.float32)) > 0
        elif d not in self.cells.pivots:
            for c in self.chunk_of[self.cells.groups * RINGS + d % ODD]:
                out[:, c] = True
        return out


_SENT = "chunk int, shard int, query boolean, uid bigint, id bigint, v binary, huge string"


def _send(routes, query: bool):
    def run(batches):
        r = routes.value
        for b in batches:
            uid = b.column(0).to_numpy()
            if query:
                row = np.arange(b.num_rows)
                chunk = r.home(b.column(4).to_numpy(), uid)
                times = r.shards[chunk]
                row, chunk = np.repeat(row, times), np.repeat(chunk, times)
                shard = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            else:
                got = [(at[i], c) for at, x in _matrix(b.column(2)).values() for i, c in [np.nonzero(r.wanted(x))]]
                row = np.concatenate([g[0] for g in got] or [np.zeros(0, int)])
                chunk = np.concatenate([g[1] for g in got] or [np.zeros(0, int)])
                with np.errstate(over="ignore"):
                    mixed = (uid[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                shard = (mixed % r.shards[chunk].astype(np.uint64)).astype(int)
            for at in range(0, len(row), 8192):
                p = slice(at, at + 8192)
                take = pa.array(row[p])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk[p], pa.int32()), pa.array(shard[p], pa.int32()), pa.array(np.full(len(take), query)),
                     *[b.column(i).take(take) for i in range(4)]], ["chunk", "shard", "query", "uid", "id", "v", "huge"])
    return run


def _exact(x: np.ndarray, huge) -> np.ndarray:
    """Rows as Python integers."""
    out = np.empty(x.shape, object)
    for i, (row, text) in enumerate(zip(x, huge, strict=True)):
        out[i] = [int(c) for c in text.split()] if text is not None else [int(c) for c in row]
    return out


def scores(q, q_huge, x, x_huge) -> np.ndarray:
    """Integer inner products, exact, clamped to the range of a long."""
    top = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    if top < _EXACT and not any(h is not None for h in (*q_huge, *x_huge)):
        return (q @ x.T).astype(np.int64)
    if not q.shape[1]:
        return np.zeros((len(q), len(x)), np.int64)
    full = _exact(q, q_huge).dot(_exact(x, x_huge).T)
    return np.clip(full, -_LONG - 1, _LONG).astype(np.int64)


class _Local:
    """The k best of a shard for every query of a chunk, of one vector length: arrays
    (queries x k), ordered by score, then id, null ids and empty places last."""

    def __init__(self, uid, ids, null, q, huge, k):
        self.uid, self.ids, self.null, self.q, self.huge, self.k = uid, ids, null, q, huge, k
        # what is kept: score, rank of the kind (0 id, 1 null id, 2 empty), id, uid
        self.best = [np.full((len(uid), k), -_LONG - 1), np.full((len(uid), k), 2),
                     np.zeros((len(uid), k), np.int64), np.zeros((len(uid), k), np.int64)]

    def add(self, uid, ids, null, x, huge):
        order = np.lexsort((uid, ids, null))
        uid, ids, null, x, huge = uid[order], ids[order], null[order], x[order], [huge[i] for i in order]
        mine = {int(u): i for i, u in enumerate(self.uid)} if np.isin(uid, self.uid).any() else {}
        own = [(mine[int(u)], j) for j, u in enumerate(uid) if int(u) in mine] if mine else []
        for at in range(0, len(self.q), 1024):
            p = np.arange(at, min(at + 1024, len(self.q)))
            s = scores(self.q[p], [self.huge[i] for i in p], x, huge)
            full = self.best[1][p, -1] < 2
            p, s = (keep := (~full) | (s.max(axis=1) >= self.best[0][p, -1])).nonzero()[0] + at, s[keep]
            if not len(p):
                continue
            kind = np.broadcast_to(null, s.shape).copy()
            row = {int(i): r for r, i in enumerate(p)}
            for i, j in own:
                if i in row:
                    kind[row[i], j] = 2
            if s.shape[1] > self.k:
                if np.abs(s).max() < 1 << 51:
                    # places in the batch break ties: it is in the order of ids
                    both = s * s.shape[1] - np.arange(s.shape[1])
                    both[kind == 2] = -_LONG
                    take = np.argpartition(-both, self.k - 1, axis=1)[:, :self.k]
                else:
                    take = np.lexsort(np.stack([-(s + 1), np.where(kind == 2, 1, 0)]), axis=1)[:, :self.k]
            else:
                take = np.broadcast_to(np.arange(s.shape[1]), s.shape)
            new = [np.take_along_axis(s, take, 1), np.take_along_axis(kind, take, 1), ids[take], uid[take]]
            both = [np.concatenate([o[p], n], axis=1) for o, n in zip(self.best, new, strict=True)]
            # -(score + 1) orders like -score and never overflows
            first = np.lexsort(np.stack([both[3], both[2], both[1], -(both[0] + 1), both[1] == 2]), axis=1)[:, :self.k]
            for o, n in zip(self.best, both, strict=True):
                o[p] = np.take_along_axis(n, first, 1)

    def rows(self):
        i, j = np.nonzero(self.best[1] < 2)
        score, kind, ids, uid = (o[i, j] for o in self.best)
        return self.uid[i], pa.array(self.ids[i], mask=self.null[i] > 0), score, pa.array(ids, mask=kind == 1), uid


def _columns(part):
    ids = part.column("id")
    null = np.asarray(ids.is_null()).astype(np.int64)
    return (part.column("uid").to_numpy(), np.asarray(ids.fill_null(0)).astype(np.int64), null,
            part.column("huge").to_pylist())


def _solve(k: int):
    """(chunk, shard, query, uid, id, v, huge), a shard's queries first -> candidates."""
    def out(locals_):
        for x in locals_.values():
            q_uid, q_id, score, vec, uid = x.rows()
            if len(q_uid):
                yield from pa.Table.from_arrays([pa.array(q_uid), q_id, pa.array(score), vec, pa.array(uid)],
                                                ["q_uid", "query_id", "score", "vec_id", "uid"]).to_batches(8192)

    def ready(held):
        table = pa.Table.from_batches(held).combine_chunks()
        uid, ids, null, huge = _columns(table)
        return {d: _Local(uid[at], ids[at], null[at], q, [huge[i] for i in at], k)
                for d, (at, q) in _matrix(table.column("v")).items()}

    def run(batches):
        key, held, locals_ = None, [], None
        for b in batches:
            tags = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
            edges = np.flatnonzero((tags[1:] != tags[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *edges], [*edges, b.num_rows], strict=True):
                if lo == hi:
                    continue
                here, part = tuple(tags[lo][:2]), b.slice(lo, hi - lo)
                if here != key:
                    yield from out(locals_ or {})
                    key, held, locals_ = here, [], None
                if tags[lo][2]:
                    held.append(part)
                    continue
                if not held:
                    continue
                if locals_ is None:
                    locals_ = ready(held)
                uid, ids, null, huge = _columns(part)
                for d, (at, x) in _matrix(part.column("v")).items():
                    if d in locals_:
                        for s in range(0, len(at), 2048):
                            w = at[s:s + 2048]
                            locals_[d].add(uid[w], ids[w], null[w], x[s:s + 2048], [huge[i] for i in w])
        yield from out(locals_ or {})
    return run


def search(table: DataFrame, query: str = "id % 100 = 0", id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
           scale: int = SCALE, pivots: int = PIVOTS, chunk: int = CHUNK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for every row for
    which ``query``, a condition on ``id``, holds."""
    spark = table.sparkSession
    rows = materialise(
        table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x"))
        .mapInArrow(_integers(scale), "id bigint, v binary, huge string")
        .select(F.monotonically_increasing_id().alias("uid"), "id", "v", "huge"), "integers")
    asked = rows.where(query)
    size = rows.agg(F.max(F.length("v")), F.count(F.lit(1))).first()
    few = max(1, min(pivots, _PIVOT_CELLS // max(1, (size[0] or 0) // 8)))
    chosen = asked.select("v", F.xxhash64("id", F.lit(12)).alias("h"), "uid").orderBy("h", "uid").limit(few).collect()
    cells = Cells([bytes(r.v) for r in chosen])
    shipped = Shipped(spark, cells)
    asked = materialise(asked.mapInArrow(_assign(shipped), "uid bigint, id bigint, v binary, huge string, cell int, dist double, norm double"),
                        "queries")
    radius, biggest, count = np.full(cells.n, -1.0), np.zeros(cells.n), np.zeros(cells.n, int)
    for r in asked.groupBy("cell").agg(F.max("dist").alias("d"), F.max("norm").alias("m"), F.count(F.lit(1)).alias("n")).collect():
        radius[r.cell], biggest[r.cell], count[r.cell] = r.d * (1 + 1e-9), r.m * (1 + 1e-9), r.n
    radius, biggest = np.nan_to_num(radius, nan=np.inf, posinf=np.inf), np.nan_to_num(biggest, nan=np.inf, posinf=np.inf)
    cells.settle(radius, biggest)

    shipped = Shipped(spark, cells)
    told = materialise(rows.select("v").mapInArrow(_summarise(shipped, k), "kind int, cell int, a double, b double, n bigint"), "summary")
    by_score = Window.partitionBy("cell").orderBy(F.desc("a"))
    score = np.full(cells.n, -np.inf)
    for r in told.where("kind = 0").withColumn("r", F.row_number().over(by_score)).where(F.col("r") == k + 1).collect():
        score[r.cell] = r.a
    groups = {r.cell: (r.n, r.a, r.b) for r in told.where("kind = 1").groupBy("cell").agg(
        F.sum("n").alias("n"), F.max("a").alias("a"), F.max("b").alias("b")).collect()}
    routes = Shipped(spark, Routes(cells, score, count, groups, size[1], chunk, shard_rows))
    data = rows.mapInArrow(_send(routes, False), _SENT)
    sent = asked.mapInArrow(_send(routes, True), _SENT).unionByName(data)
    found = materialise(sent.repartition("chunk", "shard").sortWithinPartitions("chunk", "shard", F.desc("query"))
                        .mapInArrow(_solve(k), "q_uid bigint, query_id bigint, score bigint, vec_id bigint, uid bigint"), "candidates")
    best = Window.partitionBy("q_uid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

"""Top-k search against brute force in Python's integers."""

import math
import random

import numpy as np
import pytest

from shoreline.llm import topk_search
from shoreline.llm.common import table
from shoreline.llm.queries import op12_topk

SCHEMA = "vec_id long, embedding array<double>, uid string, v string, query string, Score string"
LONG = (1 << 63) - 1


def integers(v):
    if v is None or any(c is None or not math.isfinite(c) for c in v):
        return None
    return [int(math.floor(c * 1024)) if abs(c) < 1e300 else int(c) * 1024 for c in v]


def plain(rows, every=100, k=10):
    """rows (id, vector) -> sorted (query, rank, id, score)."""
    live = [(i, x) for i, v in rows if (x := integers(v)) is not None]
    out = []
    for a, (q, x) in enumerate(live):
        if q is None or q % every:
            continue
        got = sorted((-max(-LONG - 1, min(LONG, sum(s * t for s, t in zip(x, y, strict=True)))), i is None, i or 0)
                     for b, (i, y) in enumerate(live) if a != b and len(x) == len(y))
        out += [(q, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(got[:k])]
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


def run(spark, rows, every=100, parts=4, **options):
    df = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "u", "v", "q", "s")
                                for i, v in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, topk_search.search(df, query=f"id % {every} = 0", **options).collect()), key=key)


def vectors(seed, n, d=8):
    rnd = random.Random(seed)
    base = [[rnd.gauss(0, 1) for _ in range(d)] for _ in range(4)]
    out = []
    for i in range(n):
        if i % 3 == 0:
            v = list(base[0])                                         # a third are copies
        elif i % 3 == 1:
            v = [c + rnd.gauss(0, .02) for c in rnd.choice(base)]
        else:
            v = [rnd.gauss(0, 1) * rnd.choice([.1, 1, 30]) for _ in range(d)]
        out.append((i, v))
    return out


@pytest.mark.parametrize("options", [{}, {"pivots": 3, "chunk": 4, "shard_rows": 50}, {"pivots": 1, "chunk": 2, "shard_rows": 7}])
def test_against_brute_force(spark, options):
    rows = vectors(1, 600)
    assert run(spark, rows, every=20, **options) == sorted(plain(rows, 20), key=key)


def test_odd_vectors(spark):
    rows = vectors(2, 90, 3)
    rows += [(100, None), (200, []), (300, [1.0]), (400, [float("nan"), 1, 1]), (500, [float("inf"), 1, 1]), (600, [None, 1, 1]),
             (700, [1e17, 1.0, -1.0]), (701, [1e17, 1.0, 1.0]), (702, [1.0, 0, 0]), (800, [1e308, -1e308, 1e308]), (900, [0.0, 0, 0]),
             (None, [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 3.0]), (0, rows[0][1]), (0, rows[0][1]), (1001, []), (1002, [2.0, 2.0]),
             (1100, [3.0, 1.0]), (1003, [5.0]), (1004, [-5.0])]
    for options in ({}, {"pivots": 2, "chunk": 2, "shard_rows": 9}):
        assert run(spark, rows, every=100, **options) == sorted(plain(rows), key=key)


def test_few_rows_and_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 1024 * 2048)]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    assert sorted(map(tuple, op12_topk(spark, sf).collect()), key=key) == sorted(plain(rows), key=key)


def test_bounds_hold_and_prune():
    """Near queries among others: the bounds never lose a score and leave most rows out."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 16)) * 1024
    x = np.floor(centres[rng.integers(0, 6, 3000)] + rng.standard_normal((3000, 16)) * 20)
    q = x[::50]
    cells = topk_search.Cells([v.tobytes() for v in q[:20]])
    cell, dist, norm = cells.cell(q)
    radius, biggest = np.full(cells.n, -1.0), np.zeros(cells.n)
    np.maximum.at(radius, cell, dist)
    np.maximum.at(biggest, cell, norm)
    cells.settle(radius, biggest)
    used, low, high, *_ = cells.bounds(x)
    for i, c in enumerate(used):
        exact = q[cell == c] @ x.T
        assert (exact >= low[:, i]).all() and (exact <= high[:, i]).all()
    score = -np.sort(-low, axis=0)[10]
    assert (high >= score).mean() < 0.4

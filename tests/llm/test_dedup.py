"""Exact, SimHash and vector duplicates against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from shoreline.llm import components, embedding_dedup, exact_dedup, simhash_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def least(ids):
    have = [i for i in ids if i is not None]
    return min(have) if have else None


def groups(rows):
    """Brute force: (id, keep_id, size, sha) of every row."""
    by = defaultdict(list)
    for r in rows:
        by[(r.text or "").translate(LOWER)].append(r.doc_id)
    out = []
    for text, ids in by.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return Counter(out)


@pytest.mark.parametrize("block,route", [
    (64, F.xxhash64), (1024, F.xxhash64),
    (64, lambda c: F.pmod(F.xxhash64(c), F.lit(5))),  # many blocks share a route
    (16384, lambda c: F.lit(1).cast("long"))])
def test_exact_groups(hostile, block, route):
    got = exact_dedup.duplicate_groups(hostile, block=block, route=route).collect()
    assert Counter((r.id, r.keep_id, r.group_size, r.text_sha256) for r in got) == groups(hostile.collect())
    for r in got:
        assert r.kept <= (r.id == r.keep_id)


def test_exact_drop(hostile):
    rows = hostile.collect()
    got = exact_dedup.drop_duplicates(hostile)
    assert got.columns == hostile.columns
    kept = [(r.doc_id, (r.text or "").translate(LOWER)) for r in got.collect()]
    best = {}
    for r in rows:
        t = (r.text or "").translate(LOWER)
        best[t] = max(best.get(t, -1), -1 if r.doc_id is None else r.doc_id)
    assert sorted((-1 if i is None else i, t) for i, t in kept) == sorted((i, t) for t, i in best.items())


def test_empty_tables(no_docs):
    assert exact_dedup.duplicate_groups(no_docs).count() == 0
    assert exact_dedup.drop_duplicates(no_docs).count() == 0
    assert simhash_dedup.near_duplicate_groups(no_docs).count() == 0
    assert simhash_dedup.drop_near_duplicates(no_docs).count() == 0


# --- SimHash ----------------------------------------------------------------------------


def plain_fingerprint(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r " else c for c in (text or "").translate(LOWER)).split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum((sum(h >> b & 1 for h in hs) * 2 > len(hs)) << b for b in range(64))


def plain_components(fps):
    """fp -> root by comparing all pairs."""
    u = np.array(sorted(set(fps)), np.uint64)
    root = {int(x): int(x) for x in u}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(u):
        for y in u[i + 1:][np.bitwise_count(u[i + 1:] ^ x) <= 2]:
            a, b = find(int(x)), find(int(y))
            root[max(a, b)] = min(a, b)
    return {int(x): find(int(x)) for x in u}


def test_fingerprints_and_components(hostile):
    rows = [r for r in hostile.collect() if len(r.text or "") < 20_000]
    want = {(r.doc_id, r.text): plain_fingerprint(r.text) for r in rows}
    got = simhash_dedup.near_duplicate_groups(hostile.where("coalesce(length(text), 0) < 20000")).collect()
    assert Counter((r.id, r.fp % (1 << 64)) for r in got) == Counter((r.doc_id, want[r.doc_id, r.text]) for r in rows)
    root = plain_components(want.values())
    members = defaultdict(list)
    for r in rows:
        members[root[want[r.doc_id, r.text]]].append(r.doc_id)
    for r in got:
        assert r.component_id == least(members[root[r.fp % (1 << 64)]])
    assert sum(len({(x.id, x.h) for x in got if x.kept and root[x.fp % (1 << 64)] == m}) for m in members) == len(members)


def test_simhash_matches_the_engines_hash(spark):
    texts = ["a b c", "Ünï xx YY", "one"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, h in df.select("t", F.xxhash64("t")).collect():
        assert h % (1 << 64) == xxhash.xxh64_intdigest(t.encode(), 42)


def test_simhash_drop(hostile):
    got = simhash_dedup.drop_near_duplicates(hostile)
    assert got.columns == hostile.columns
    report = simhash_dedup.near_duplicate_groups(hostile).collect()
    comps = {r.component_id for r in report if r.component_id is not None}
    kept = [r.doc_id for r in got.collect()]
    assert comps <= set(kept)
    assert len(kept) == len({(r.id, r.h) for r in report if r.kept})


@pytest.mark.parametrize("homes,size", [(2, 3), (2, 40), (2048, 20), (2048, 1 << 15)])
def test_links_find_every_component(spark, monkeypatch, homes, size):
    """Clusters around a few centres, some far too large for one tile."""
    monkeypatch.setattr(simhash_dedup, "TILE_HOMES", homes)
    monkeypatch.setattr(simhash_dedup, "TILE_ROWS", size)
    rng = np.random.default_rng(1)
    fps = set()
    for _ in range(6):
        x = int(rng.integers(0, 1 << 63))
        for _ in range(60):
            y = x
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    fps |= {0, (1 << 64) - 1, 3, 1 << 63}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4)
    links = simhash_dedup.links(df)
    comp = {r.node % (1 << 64): r.root % (1 << 64) for r in components.connected_components(links).collect()}
    want = plain_components(fps)
    mine = defaultdict(set)
    theirs = defaultdict(set)
    for f in fps:
        mine[comp.get(f, f)].add(f)
        theirs[want[f]].add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_a_hot_anchor_is_dealt_on_both_sides(spark, monkeypatch):
    """Each home row meets each row of its group in one tile; no tile holds more than about
    two blocks."""
    monkeypatch.setattr(simhash_dedup, "TILE_HOMES", 50)
    monkeypatch.setattr(simhash_dedup, "TILE_ROWS", 200)
    rows = spark.createDataFrame([(1, f, f % 2 == 0) for f in range(2000)] + [(2, f, True) for f in range(9)]
                                 + [(3, f, False) for f in range(500)], "key long, fp long, home boolean")
    tiles = defaultdict(lambda: ([], []))
    for r in simhash_dedup._tiles(rows, "key").collect():
        homes, plain = tiles[(r.key, r.i, r.j)]
        (homes if r.home else plain).append(r.fp)
    assert max(len(h) for h, _ in tiles.values()) < 100
    assert max(len(p) for _, p in tiles.values()) < 300
    met = Counter((h, p) for (key, _, _), (hs, ps) in tiles.items() if key == 1 for h in hs for p in ps)
    assert met == Counter((h, p) for h in range(0, 2000, 2) for p in range(2000))
    assert sorted(tiles[(2, 0, 0)][0]) == list(range(9)) and not any(key == 3 for key, _, _ in tiles)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_near_fingerprints_share_a_segment(spark, n):
    rng = np.random.default_rng(n)
    x = rng.integers(-(1 << 63), (1 << 63) - 1, 200, dtype=np.int64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, n - 1, replace=False):
            y[i] ^= np.int64(np.uint64(1 << int(b)).astype(np.int64))
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), strict=True)), "x long, y long")
    got = df.select(simhash_dedup._segments(F.col("x"), n).alias("p"), simhash_dedup._segments(F.col("y"), n).alias("q"))
    for r in got.collect():
        assert len(r.p) == n and any(a == b for a, b in zip(r.p, r.q, strict=True))
    whole = df.select("x", simhash_dedup._segments(F.col("x"), n).alias("p")).distinct()
    assert whole.select("p").distinct().count() == whole.count()


def test_every_anchor_within_reach_is_used():
    """Any two fingerprints within two bits meet at the home anchor of either."""
    rng = np.random.default_rng(2)
    x = rng.integers(-(1 << 63), (1 << 63) - 1, 500, dtype=np.int64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, rng.integers(1, 3), replace=False):
            y[i] ^= np.int64(np.uint64(1 << int(b)).astype(np.int64))
    r, a, h = simhash_dedup.anchors(x)
    home = dict(zip(r[h].tolist(), a[h].tolist(), strict=True))
    r, a, _ = simhash_dedup.anchors(y)
    reach = set(zip(r.tolist(), a.tolist(), strict=True))
    assert len(reach) == len(r) and all((i, home[i]) in reach for i in range(len(x)))


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(1000, 1100)]
    df = spark.createDataFrame(path + star + [(7, 7), (3, None)], "a long, b long")
    got = {r.node: r.root for r in components.connected_components(df).collect()}
    assert all(got[i] == 100 for i in range(101, 161)) and all(got[i] == 5 for i in range(1000, 1100))
    assert 7 not in got


# --- vectors ------------------------------------------------------------------------------


def test_vectors(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((40, 32))
    rows = [(i, (centre[i % 40] + rng.standard_normal(32) * s).tolist(), 1)
            for i, s in enumerate(rng.choice([0.02, 0.2, 0.25, 0.3, 2.0], 900))]
    rows += [(2000 + i, rows[5][1], 2) for i in range(30)] + [(2100, [v * 3 for v in rows[5][1]], 2)]
    odd = [(3000, None, 1), (3001, [], 1), (3002, [0.0] * 32, 1), (3003, [float("nan")] * 32, 1),
           (3004, [None] + [1.0] * 31, 1), (3005, [float("inf")] + [1.0] * 31, 1), (3006, [1.0] * 5, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + odd],
                               "vec_id long, embedding array<double>, label int, unit string, v int").repartition(5)
    got = {r.id: r for r in embedding_dedup.near_duplicate_groups(df).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    ids = [r[0] for r in rows]
    found = sum(got[i].n_links for i in ids)
    assert all(got[i].n_links <= n for i, n in zip(ids, near.sum(1), strict=True))
    assert found >= 0.99 * near.sum() and near.sum() > 5000
    comp = {i: i for i in ids}
    for _ in range(50):
        for k, i in enumerate(ids):
            comp[i] = min([comp[i], *(comp[ids[j]] for j in np.flatnonzero(near[k]))])
    assert np.mean([got[i].component_id == comp[i] for i in ids]) > 0.99
    for i, *_ in odd:
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept
    assert len({got[2000 + i].component_id for i in range(30)} | {got[2100].component_id}) == 1


def test_large_bucket_over_shards(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", 16)
    rng = np.random.default_rng(5)
    c = rng.standard_normal(16)
    x = c + rng.standard_normal((300, 16)) * 0.05
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.id: r for r in embedding_dedup.near_duplicate_groups(df).collect()}
    x = x.astype(np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.95).sum(1) - 1
    assert np.mean([got[i].n_links == n for i, n in enumerate(want)]) > 0.99
    assert all(got[i].n_links <= n for i, n in enumerate(want))


@pytest.mark.parametrize("limit,value", [("SHARD_ROWS", 32), ("SHARD_BYTES", 32 * 16 * 8)])
def test_a_task_holds_two_blocks_of_a_large_bucket(spark, monkeypatch, limit, value):
    """All vectors share their buckets; no group that is compared has more than two blocks."""
    monkeypatch.setattr(embedding_dedup, limit, value)
    found, materialise = [], embedding_dedup.materialise

    def largest(*_):
        def run(batches):
            seen = Counter()
            for b in batches:
                seen.update(zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([max(seen.values())]), pa.array([0]), pa.array([0])],
                                                 ["a", "b", "links"])
        return run

    def keep(df, name):
        out = materialise(df, name)
        found.extend([out] if name == "found" else [])
        return out

    monkeypatch.setattr(embedding_dedup, "_compare", largest)
    monkeypatch.setattr(embedding_dedup, "materialise", keep)
    rng = np.random.default_rng(8)
    x = rng.standard_normal(16) + rng.standard_normal((1000, 16)) * 1e-4
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    embedding_dedup.near_duplicate_groups(df)
    most = max(r.a for r in found[0].collect())
    assert 32 < most < 3 * 32
    monkeypatch.undo()
    monkeypatch.setattr(embedding_dedup, limit, value)
    got = embedding_dedup.near_duplicate_groups(df).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(999, 0)}


def test_vectors_of_every_length_and_size_are_compared(spark):
    rng = np.random.default_rng(6)
    rows, want = [], {}
    for d, at in ((1, 0), (3, 100), (8, 200), (9, 300), (64, 400)):
        for k in range(6):
            v = rng.standard_normal(d)
            for copy in range(3):
                rows.append((at + 10 * k + copy, (v + (rng.standard_normal(d) * 1e-3 if d > 1 else 0)).tolist()))
    rows += [(900, [1.7e308, 1.7e308]), (901, [1.7e308, 1.7e308]), (902, [1.0, 1.0]), (903, [1e-300, 1e-300]),
             (904, [5e-324, 5e-324]), (905, [-1.7e308, 1.7e308])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {r.id: r for r in embedding_dedup.near_duplicate_groups(df).collect()}

    def unit(v):
        v = np.array(v) / np.abs(v).max()
        return v / np.linalg.norm(v)
    for i, v in rows:
        want[i] = sum(len(v) == len(w) and unit(v) @ unit(w) >= 0.95 for j, w in rows if j != i)
    assert {i: got[i].n_links for i, _ in rows} == want
    assert want[900] == 4 and want[905] == 0


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_duplicate_groups(df).count() == 0

"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64-bit majorities over hashed word shingles.  Equal fingerprints
are merged first, so a group of copies costs one row.  The anchors are the words of
a covering code of length 64: two perfect Golay codes [23,12] (radius 3), the
repetition code of length 17 (radius 8) and one free bit, 2^26 anchors in all.  The
home anchor of a fingerprint is the nearest word of each part.  A fingerprint is
replicated to every anchor that lies, over the parts, within the covering radius
plus the threshold (about 75 anchors at threshold 2): that includes the home anchor
of every fingerprint it may link with, so comparing home rows with all rows of an
anchor finds every link.  Rows are compared in sorted order per anchor by vectorised
exclusive-or; each task hands on a spanning forest of the links it found, never the
pairs.

An anchor with too many rows for one task is compared segment by segment: fingerprints
that differ in at most ``max_bits`` bits agree in one of ``max_bits + 1`` segments, so its
rows are grouped by the value of each.  A group that is still too large is dealt on both
sides, and each pair of a block of home rows and a block of rows is a tile of its own, so
a task holds two blocks whatever the anchor.

Defined cases: a null text counts as empty; texts without words have fingerprint
zero, which links like any other; a null id is reported with its component and sorts
above every other id, so it names a component only where all its members lack one;
repeated rows are reported each; an empty table gives an empty report; other columns
are not read, and come through ``drop_near_duplicates`` as they are.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_rows, materialise
from .components import connected_components, forest

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Home rows and rows of one tile of a large group, about: what a task holds of it.
TILE_HOMES = 2048
TILE_ROWS = 1 << 15
_CHUNK = 1 << 16
_PAIRS = 1 << 20


# --- fingerprints ---------------------------------------------------------------------


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts, n = iter([b" ".join(words)]), 1
    else:
        parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
        n = len(words) - shingle + 1
    digests = b"".join(map(xxhash.xxh64_digest, parts, repeat(SEED)))
    bits = np.frombuffer(digests, np.uint8).reshape(n, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        ones += np.unpackbits(bits[at:at + _CHUNK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """bytes.split() parts at 0x09-0x0D and 0x20 and bytes.lower() maps A-Z only."""
    def run(parts):
        for s in parts:
            yield pd.Series([fingerprint(t, shingle) for t in s], dtype="int64")

    from collections.abc import Iterator
    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "long").asNondeterministic()(text)


# --- the covering code ----------------------------------------------------------------

_GOLAY = 0b101011100011  # generator polynomial of the perfect [23,12] code


def _golay_tables(extra: int):
    """Syndrome tables and, per syndrome, the error patterns by weight above 3."""
    def remainder(x):
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= _GOLAY << (bit - 11)
        return x

    unit = np.array([remainder(1 << b) for b in range(23)], np.int64)
    low, high = np.zeros(4096, np.int64), np.zeros(2048, np.int64)
    for b in range(12):
        low[1 << b:2 << b] = low[:1 << b] ^ unit[b]
    for b in range(11):
        high[1 << b:2 << b] = high[:1 << b] ^ unit[12 + b]
    # all patterns of weight up to 3 + extra, built by adding a higher bit
    level = [np.zeros(1, np.int64)]
    for _ in range(3 + extra):
        last = level[-1]
        nxt = [last[last < (1 << b)] | (1 << b) for b in range(23)]
        level.append(np.unique(np.concatenate(nxt)))
    tables = []
    for e in range(extra + 1):
        pats = np.concatenate(level[:4]) if e == 0 else level[3 + e]
        syn = low[pats & 4095] ^ high[pats >> 12]
        order = np.argsort(syn, kind="stable")
        syn, pats = syn[order], pats[order]
        rank = np.arange(len(syn)) - np.searchsorted(syn, syn)
        t = np.full((2048, int(rank.max()) + 1), -1, np.int64)
        t[syn, rank] = pats
        tables.append(t)
    return low, high, tables


def anchors(fp: np.ndarray, max_bits: int = MAX_BITS, tables=None):
    """(row, anchor, home) of every anchor each fingerprint is replicated to."""
    low, high, golay = tables or _golay_tables(max_bits)
    x = fp.astype(np.uint64)
    mask23 = np.uint64((1 << 23) - 1)
    parts = [(x & mask23).astype(np.int64), (x >> np.uint64(23) & mask23).astype(np.int64)]
    rep = (x >> np.uint64(46) & np.uint64((1 << 17) - 1)).astype(np.int64)
    top = (x >> np.uint64(63)).astype(np.int64)
    syn = [low[p & 4095] ^ high[p >> 12] for p in parts]
    weight = np.bitwise_count(rep).astype(np.int64)
    major = (weight > 8).astype(np.int64)
    flip = np.where(major == 1, weight - 8, 9 - weight)  # excess of the other repetition word
    rows, out, homes = [], [], []
    every = np.arange(len(x))
    for e1 in range(max_bits + 1):
        for e2 in range(max_bits + 1 - e1):
            left = max_bits - e1 - e2
            for r in (0, 1):
                for t in (0, 1):
                    if t > left:
                        continue
                    sel = every if not r else every[flip <= left - t]
                    if not len(sel):
                        continue
                    a1 = golay[e1][syn[0][sel]]
                    a2 = golay[e2][syn[1][sel]]
                    i, j, k = np.nonzero((a1 >= 0)[:, :, None] & (a2 >= 0)[:, None, :])
                    s = sel[i]
                    word = (parts[0][s] ^ a1[i, j]) | (parts[1][s] ^ a2[i, k]) << 23
                    bit = major[s] ^ r
                    word |= (bit * ((1 << 17) - 1)) << 46
                    word = word.astype(np.uint64) | ((top[s] ^ t).astype(np.uint64) << np.uint64(63))
                    rows.append(s)
                    out.append(word.astype(np.int64))
                    homes.append(np.full(len(s), e1 + e2 + r + t == 0))
    return np.concatenate(rows), np.concatenate(out), np.concatenate(homes)


def _replicate(max_bits: int):
    def run(batches):
        tables = _golay_tables(max_bits)
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 4096):
                part = fp[at:at + 4096]
                r, a, h = anchors(part, max_bits, tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(part[r]), pa.array(h)], ["anchor", "fp", "home"])
    return run


# --- comparing per anchor -------------------------------------------------------------


def _compare(max_bits: int):
    """(anchor, tile, fp, home) sorted by (anchor, tile) -> links between the home rows and
    all rows of each, as a forest."""
    def group_links(keys, fps, home):
        """Links between the home rows and all rows of each group, in bounded steps."""
        start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[start, len(keys)])
        group = np.repeat(np.arange(len(start)), size)
        h = np.flatnonzero(home & (size[group] > 1))
        need = size[group[h]]
        us, vs = [], []
        at = 0
        while at < len(h):
            stop = at + max(1, int(np.searchsorted(np.cumsum(need[at:at + _PAIRS]), _PAIRS, "right")))
            hh, n = h[at:stop], need[at:stop]
            left = np.repeat(hh, n)
            right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[group[hh]], n)
            d = np.bitwise_count(fps[left] ^ fps[right])
            ok = (d <= max_bits) & (left != right)
            if ok.any():
                us.append(fps[left[ok]].view(np.int64))
                vs.append(fps[right[ok]].view(np.int64))
                if sum(map(len, us)) > _PAIRS:
                    u, v = forest(np.concatenate(us), np.concatenate(vs))
                    us, vs = [u], [v]
            at = stop
        if not us:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(us), np.concatenate(vs)

    def run(batches):
        rest = None
        us, vs, held = [], [], 0

        def add(group, fp, home):
            nonlocal held
            u, v = group_links(group, fp.view(np.uint64), home)
            us.append(u)
            vs.append(v)
            held += len(u)
            if held > _PAIRS:
                u, v = forest(np.concatenate(us), np.concatenate(vs))
                us[:], vs[:], held = [u], [v], 0

        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if rest is not None:
                cols = [np.concatenate(c) for c in zip(rest, cols, strict=True)]
            if not len(cols[0]):
                continue
            new = np.zeros(len(cols[0]), bool)
            for key in cols[:2]:
                new[1:] |= key[1:] != key[:-1]
            group = np.cumsum(new)
            cut = int(np.searchsorted(group, group[-1]))
            rest = [c[cut:] for c in cols]
            if cut:
                add(group[:cut], cols[2][:cut], cols[3][:cut])
        if rest is not None and len(rest[0]):
            add(np.zeros(len(rest[0]), np.int64), rest[2], rest[3])
        if sum(map(len, us)):
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            for at in range(0, len(u), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u[at:at + 50_000]), pa.array(v[at:at + 50_000])], ["a", "b"])
    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct ``fp`` values -> (a, b): links whose components are those of all pairs
    within ``max_bits`` bits."""
    rows = fps.select("fp").mapInArrow(_replicate(max_bits), "anchor long, fp long, home boolean")
    hot = _hot_anchors(rows, fps.count())
    if hot is None:
        dealt = rows.withColumn("tile", F.lit(0).cast("long"))
    else:
        cold = rows.join(hot.select("anchor"), "anchor", "left_anti")
        # rows of an anchor that is nobody's home are compared at other anchors
        split = rows.join(hot.where("homes > 0").select("anchor"), "anchor")
        split = materialise(split.select("anchor", "fp", "home", F.posexplode(_segments(F.col("fp"), max_bits + 1))
                                         .alias("part", "bits")), "split")
        # tiles whose numbers collide are compared together, which loses nothing
        tile = F.xxhash64("part", "bits", "i", "j").alias("tile")
        dealt = (cold.withColumn("tile", F.lit(0).cast("long"))
                 .unionByName(_tiles(split, "anchor", "part", "bits").select("anchor", tile, "fp", "home")))
    dealt = (dealt.select("anchor", "tile", "fp", "home").repartition("anchor", "tile")
             .sortWithinPartitions("anchor", "tile"))
    return dealt.mapInArrow(_compare(max_bits), "a long, b long")


def _hot_anchors(rows: DataFrame, n: int) -> DataFrame | None:
    """Anchors with too many of the replicas of ``n`` fingerprints for one task, counted in
    two steps: nearly all anchors are small, and the sums over hashed sets of anchors, few
    groups on the map side, show for most sets that all of theirs are."""
    sets = 1 << min(22, max(10, (n >> 5).bit_length()))
    rows = rows.withColumn("set", F.pmod(F.xxhash64("anchor"), F.lit(sets)))
    full = materialise(_large(rows, "set"), "full")
    if full.isEmpty():
        return None
    hot = materialise(_large(rows.join(full.select("set"), "set", "left_semi"), "anchor"), "hot")
    return None if hot.isEmpty() else hot


def _large(rows: DataFrame, *key: str) -> DataFrame:
    """Groups too large for one task, with the numbers of their rows and home rows."""
    return (rows.groupBy(*key).agg(F.count(F.lit(1)).alias("size"), F.count_if("home").alias("homes"))
            .where((F.col("size") > TILE_ROWS) | (F.col("homes") > TILE_HOMES)))


def _segments(fp: Column, n: int) -> Column:
    """The 64 bits as ``n`` numbers: of two fingerprints that differ in fewer than ``n``
    bits at least one is equal."""
    ends = [64 * i // n for i in range(n + 1)]
    out = []
    for lo, hi in zip(ends, ends[1:], strict=False):
        part = F.shiftrightunsigned(fp, lo)
        out.append(part if hi - lo == 64 else part.bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long")))
    return F.array(*out)


def _tiles(rows: DataFrame, *key: str) -> DataFrame:
    """``rows`` with a tile (i, j): home rows are dealt over blocks i and stand in every
    tile of their block; all rows are dealt over blocks j likewise, as plain rows.  Groups
    that fit one task are one tile."""
    large = materialise(
        _large(rows, *key).select(*key, F.ceil(F.col("homes") / TILE_HOMES).cast("int").alias("ni"),
                                  F.ceil(F.col("size") / TILE_ROWS).cast("int").alias("nj")), "large")
    small = (rows.join(large.select(*key), list(key), "left_anti")
             .withColumn("i", F.lit(0)).withColumn("j", F.lit(0)))
    if large.isEmpty():
        return small
    rows = rows.join(large.where("ni > 0"), list(key))
    own_i = F.pmod(F.xxhash64("fp"), F.col("ni")).cast("int")
    own_j = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("nj")).cast("int")
    homes = rows.where("home").withColumn("i", own_i).withColumn("j", F.explode(F.expr("sequence(0, nj - 1)")))
    plain = (rows.withColumn("home", F.lit(False)).withColumn("j", own_j)
             .withColumn("i", F.explode(F.expr("sequence(0, ni - 1)"))))
    return small.unionByName(homes.unionByName(plain).drop("ni", "nj"))


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: id, h (hash of the text), fp (signed long),
    component_id, kept (one document of each component)."""
    prints = materialise(docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"),
                                     fingerprint_column(F.col(text_col), shingle).alias("fp")), "prints")
    who = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    fps = materialise(prints.groupBy("fp").agg(F.min(who).alias("low")), "fps")
    comp = connected_components(links(fps, max_bits))
    rooted = materialise(
        fps.join(comp, fps.fp == comp.node, "left")
        .select("fp", "low", F.coalesce("root", "fp").alias("root")), "rooted")
    named = materialise(rooted.groupBy("root").agg(F.min("low").alias("keep")), "named")
    of = materialise(rooted.join(named, "root").select("fp", "keep"), "of")
    return prints.join(of, "fp").select("id", "h", "fp", F.col("keep.id").alias("component_id"),
                                        (who == F.col("keep")).alias("kept"))


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The columns of ``docs``; of each component the document with the smallest id
    stays (one row, where that id repeats)."""
    report = materialise(near_duplicate_groups(docs, id_col, text_col, shingle, max_bits), "report")
    key = {"id": F.col(id_col), "h": F.xxhash64(F.col(text_col))}
    kept = drop_rows(docs, report.where("NOT kept").select("id", "h").distinct(), key)
    again = report.where("kept").groupBy("id", "h").count().where("count > 1").select("id", "h")
    if again.isEmpty():
        return kept
    repeated = drop_rows(kept, again, key, "left_semi")
    return drop_rows(kept, again, key).unionByName(repeated.dropDuplicates([id_col, text_col]))

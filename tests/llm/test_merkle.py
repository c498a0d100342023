"""Merkle manifest against hashlib, on trees of every shape and hostile rows."""

import hashlib
import random
import zlib

import pytest

from shoreline.llm import merkle
from shoreline.llm.common import table
from shoreline.llm.queries import op11_merkle

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
COLS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, tree string, leaf string, Total string"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """(root, per node the list of (left, right) siblings by level)."""
    paths = [[] for _ in nodes]
    owner = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, held = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at:at + 8]
            for j in range(len(run)):
                for i in owner[at + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(h("".join(run)))
            held.append([i for o in owner[at:at + 8] for i in o])
        nodes, owner = up, held
    return nodes[0], paths


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs, known = [], []
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        subs.append(tree([x[2] for x in groups[g]]))
    root, top = tree([s[0] for s in subs])
    out = []
    for g, (sub, paths), above in zip(order, subs, top, strict=True):
        for (_, _, digest, r), path in zip(groups[g], paths, strict=True):
            hit = zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 0
            folded = leaf(r, r["text"] and r["text"].translate(LOWER)) if hit else digest
            for a, b in path + above:
                folded = h(a + folded + b)
            out.append((r["doc_id"], digest, sub, root, h("".join(a + b for a, b in path + above)), folded, folded == root))
    return out


def key(r):
    return tuple((x is None, str(x)) for x in r)


def compare(got, rows):
    assert sorted(map(tuple, got), key=key) == sorted(plain(rows), key=key)


def run(df):
    tampered, when = merkle.tampered_thirds()
    return merkle.manifest(df, tampered=tampered, when=when).collect()


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 8}, {"a": 9}, {None: 1, "b": 65, "é": 64, "z": 513},
                                   {f"l{i}": 1 + i % 10 for i in range(75)}])
def test_shapes(spark, sizes):
    rnd = random.Random(len(sizes))
    rows = [{"doc_id": i * 7 % 1009, "text": rnd.choice(["Word " * rnd.randrange(9), "", None, "Ünïcode A", "lower"]), "lang": g,
             "source": rnd.choice([None, "s", "é"]), "n_chars": rnd.choice([None, 0, 5])}
            for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "i", "t", "l", "T") for r in rows],
                               SCHEMA).repartition(5)
    compare(run(df), rows)


def test_hostile(spark, hostile, no_docs):
    compare(run(hostile), [r.asDict() for r in hostile.select(*COLS).collect()])
    assert run(no_docs) == []


def test_query_and_untampered(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    compare(op11_merkle(spark, sf).collect(), [r.asDict() for r in docs.collect()])
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", None) == limit
    whole = merkle.manifest(docs)
    assert whole.where("NOT verified OR verified IS NULL").count() == 0 and whole.count() == docs.count()


def test_plan_has_no_group_in_one_task(spark, hostile):
    """A group's order comes from a sort by range: no window over a group's rows."""
    dealt, offsets = merkle.ranked(hostile.select("doc_id", "lang"), "lang", ["doc_id"], "test")
    assert dealt.count() == hostile.count()
    assert offsets.count() <= spark.sparkContext.defaultParallelism * 4 + 3

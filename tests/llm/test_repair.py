"""Conversation repair against a whole-string search from the end, with conversations cut
over tasks and stretches, and on hostile tables."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shoreline.llm import conversation_repair as cr
from shoreline.llm.common import table
from shoreline.llm.queries import op13_repair

NEXT = {"": "u", "s": "u", "a": "u", "u": "a"}
SCHEMA = "conv_id long, turn long, role string, text string, conv string, part string, audit string, Real string"


def plain(rows):
    """The contract's result for one conversation's damaged rows (turn, role, text) in order."""
    seen, info, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        info.append(fault)
    best = {"": (0, "", ()), "s": (10, "II", (("user", ""), ("assistant", ""))), "u": (5, "I", (("assistant", ""),)), "a": (0, "", ())}
    for (_, role, text), fault in reversed(list(zip(rows, info, strict=True))):
        new = {}
        for state in best:
            ways, at, pre, lines = [], state, "", ()
            for _ in range(3):
                base = 5 * len(pre)
                c, a, o = best[at]
                ways.append((base + 2 + c, pre + "D" + a, lines + o))
                if fault not in ("blank", "duplicate"):
                    base += 5 * (fault == "truncated")
                    to = "s" if at == "" and role[:1] == "s" else NEXT[at]
                    if role[:1] == to:
                        c, a, o = best[to]
                        ways.append((base + c, pre + "K" + a, lines + ((role, text),) + o))
                    c, a, o = best[NEXT[at]]
                    ways.append((base + 1 + c, pre + "R" + a, lines + (({"u": "user", "a": "assistant"}[NEXT[at]], text),) + o))
                lines += (({"u": "user", "a": "assistant"}[NEXT[at]], ""),)
                at, pre = NEXT[at], pre + "I"
            new[state] = min(ways)
        best = new
    cost, audit, lines = best[""]
    turns = {t for t, _, _ in rows if t is not None}
    return {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **counts,
            "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False)),
            "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()}


def damaged(rows):
    """{conversation: its damaged rows in order} of (conv_id, turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        here = out.setdefault(conv, [])
        text = "" if k == 1 else text.translate({ord(c): None for c in ".!?"}) if k == 2 else text
        here += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def check(rows, report):
    want = {c: plain(r) for c, r in damaged(rows).items()}
    got = {r.conv: {k: v for k, v in r.asDict().items() if k != "conv"} for r in report}
    assert len(got) == len(report)
    assert got == want


def made(seed, convs, long_one):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "usher"]
    texts = ["Yes.", "No", "", None, " \n", "Why?", "same.", "ünï!", "x" * 5000 + "."]

    def row(c, t):
        return c, t, rnd.choices(roles, [5, 5, 2, 1, 1, 1, 1])[0], rnd.choices(texts, [4, 2, 1, 1, 1, 4, 4, 2, 1])[0] if rnd.random() < .5 \
            else f"text {rnd.random()}."
    rows = [row(c, rnd.choice([t, t, t, None, rnd.randrange(5)])) for c in range(convs) for t in range(rnd.randrange(1, 9))]
    rows += [row(None, t) for t in (0, 1, None)]
    rows += [row(7_000, t) for t in range(long_one)]
    rows += rows[:5]
    return rows


@pytest.mark.parametrize("seed,block,parts", [(1, 8192, 1), (2, 16, 5), (3, 4, 3)])
def test_against_search_from_the_end(spark, seed, block, parts):
    rows = made(seed, 60, 300)
    df = spark.createDataFrame([(*r, "x", "y", None, "z") for r in rows], SCHEMA).repartition(parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hurt, real = cr.damage(df)
        check(rows, cr.repair(hurt, real=real, block=block).report.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_large_texts_go_by_stretches(spark):
    rows = made(5, 20, 40)
    hurt, real = cr.damage(spark.createDataFrame([(*r, "x", "y", None, "z") for r in rows], SCHEMA))
    check(rows, cr.repair(hurt, real=real, chars=200).report.collect())


def test_parts_hold_the_repaired_turns(spark):
    rows = made(6, 30, 120)
    hurt, real = cr.damage(spark.createDataFrame([(*r, "x", "y", None, "z") for r in rows], SCHEMA))
    got = cr.repair(hurt, real=real, block=16)
    lines, sha = {}, {r.conv: (r.repaired_sha256, r.audit) for r in got.report.collect()}
    for r in sorted(got.parts.collect(), key=lambda r: r.part):
        seen = lines.setdefault(r.conv, ([], []))
        seen[0].extend(f"{t.role}:{t.text}" for t in r.turns)
        seen[1].append(r.audit)
    for conv, (said, audit) in lines.items():
        initials = "".join(x[0] for x in said)
        assert initials in ("", "s" * (initials[:1] == "s") + "ua" * (len(initials) // 2))
        assert sha[conv] == (hashlib.sha256("\n".join(said).encode()).hexdigest(), "".join(audit))


def test_query_and_empty_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "conversations").collect()]
    check(rows, op13_repair(spark, sf).withColumnRenamed("conv_id", "conv").collect())
    hurt, real = cr.damage(spark.createDataFrame([], SCHEMA))
    assert cr.repair(hurt, real=real).report.collect() == []


def test_halves_meet_as_the_whole(spark):
    rnd = random.Random(9)
    for _ in range(400):
        symbols = [rnd.randrange(9) for _ in range(rnd.randrange(1, 30))]
        words, state, cost = cr.solve(symbols, cr.START)
        size = rnd.randrange(1, 6)
        parts = [symbols[i:i + size] for i in range(0, len(symbols), size)]
        states = cr.crossings([[cr.forward(p, 0, len(p), s) for s in range(4)] for p in parts])
        pieces = [cr.solve(p, a, cr.only(b) if i < len(parts) - 1 else cr._LAST)[0]
                  for i, (p, a, b) in enumerate(zip(parts, states, states[1:], strict=False))]
        assert [w for p in pieces for w in p] == words and states[-1] == state
        assert cost < 1 << 40


def test_no_text_is_read_twice_by_tasks(spark):
    """A conversation larger than a stretch is dealt over tasks."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(200)]
    df = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)
    got = cr.repair(df, block=32)
    assert got.parts.where(F.col("conv") == 1).count() >= 200 // 32
    assert got.report.first().audit == "K" * 200

"""Repair of conversations by Hirschberg's divide and conquer.

A conversation's rows, in order, are edited at least cost until the initials of the
roles read ``(s?(ua)+)?``.  Four states say what may follow: START, after the system
row, after a user row, DONE after an assistant row.  Keep costs 0, Rerole to user or
assistant 1, Delete 2 (blank rows and duplicates must go), Insert of an empty user or
assistant row 5; a truncated row that stays adds 5.

Forward and backward cost vectors over the four states meet in the middle; of the
optimal crossings the one whose edits so far read least is taken, and both halves are
solved alone.  Only vectors are kept, never a table of states by rows.  A crossing is
the state right after a row's own edit, so inserts belong to the row they precede; of
two different prefixes none then begins the other, and their order decides that of the
whole.  The forward vector carries that order as four ranks instead of the prefixes.

The same recursion runs across tasks.  Rows are dealt by range of (conversation, turn),
so a conversation of a third of all rows is cut over many tasks.  One that lies inside
a task is solved there.  The rows of the others are written; each stretch of ``BLOCK``
rows answers its cost vectors from all four states, the vectors of a conversation's
stretches choose the crossings between them, and the stretches are solved apart.  The
repaired text passes through one task only as a running SHA-256, one stretch at a time.

Faults, the first that applies: blank (no character but white space), duplicate (role
and text seen earlier in the conversation), truncated (the last such character ends no
sentence).

Defined cases: a null role or text counts as one space; a null turn comes first and is
ignored in gaps; rows of one turn are ordered by role, then by the text's first 64
characters, then by its hash; repeated rows are duplicates; a null conversation id is a
conversation of its own; one without rows is reported with zeros and an empty audit; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Rows of a stretch; longer conversations are solved in several.
BLOCK = 8192
#: Characters of a conversation solved where it lies; larger ones are written and dealt.
CHARS = 1 << 26
SPACE = " \t\n\v\f\r"
START, SYSTEM, USER, DONE = range(4)
_INF = 1 << 60
_AFTER_INSERT = {START: USER, SYSTEM: USER, DONE: USER, USER: DONE}
#: Inserts that end a conversation properly, by the state after its last row.
_ENDING = (0, 2, 1, 0)
_LAST = tuple(5 * n for n in _ENDING)
GONE = 0


def symbol(role: str, gone: bool, truncated: bool) -> int:
    return GONE if gone else 1 + 2 * "sua".find(role[:1] or "?") % 8 + truncated


def _moves(sym: int):
    """step[x][y]: the cheapest (cost, edits) that take state x over one row to y."""
    kind, extra = ((sym - 1) // 2, 5 * ((sym - 1) % 2)) if sym else (3, 0)
    step = [[None] * 4 for _ in range(4)]
    for x in range(4):
        at, word, cost, seen = x, "", 0, set()
        while at not in seen:
            seen.add(at)
            ways = [(cost + 2, word + "D", at)]
            if sym:
                if kind == 0 and at == START:
                    ways.append((cost + extra, word + "K", SYSTEM))
                if kind == (2 if at == USER else 1):
                    ways.append((cost + extra, word + "K", _AFTER_INSERT[at]))
                ways.append((cost + extra + 1, word + "R", _AFTER_INSERT[at]))
            for c, w, y in ways:
                if step[x][y] is None or (c, w) < step[x][y]:
                    step[x][y] = c, w
            at, word, cost = _AFTER_INSERT[at], word + "I", cost + 5
    return step


STEPS = [_moves(s) for s in range(9)]


def choose(costs, ranks, steps):
    """(costs, ranks) before -> after one step; ``steps[x][y]`` is (cost, order of the
    edits among the ways from x) or None."""
    got = []
    for y in range(4):
        ways = [(costs[x] + steps[x][y][0], ranks[x], steps[x][y][1]) for x in range(4)
                if costs[x] < _INF and steps[x][y] is not None]
        got.append(min(ways) if ways else None)
    order = sorted((g[1:], y) for y, g in enumerate(got) if g)
    rank = [0] * 4
    for i, (_, y) in enumerate(order):
        rank[y] = i
    return tuple(g[0] if g else _INF for g in got), tuple(rank)


@lru_cache(1 << 14)
def _forward_step(costs, ranks, sym):
    low = min(costs)
    costs, ranks = choose(costs, ranks, STEPS[sym])
    shift = min(costs)
    return tuple(c - shift if c < _INF else c for c in costs), ranks, shift - low


def forward(symbols, lo: int, hi: int, start: int):
    """(costs, ranks) by state after the rows lo to hi, from ``start``."""
    costs, ranks, total = tuple(0 if s == start else _INF for s in range(4)), (0,) * 4, 0
    for i in range(lo, hi):
        costs, ranks, shift = _forward_step(costs, ranks, symbols[i])
        total += shift
    return tuple(c + total if c < _INF else c for c in costs), ranks


@lru_cache(1 << 14)
def _backward_step(costs, sym):
    new = [min((w[0] + costs[y] for y, w in enumerate(row) if w and costs[y] < _INF), default=_INF)
           for row in STEPS[sym]]
    shift = min(new)
    return tuple(c - shift if c < _INF else c for c in new), shift


def backward(symbols, lo: int, hi: int, end):
    """Cost by state before row lo of the rows lo to hi, with ``end`` after them."""
    total = min(end)
    costs = tuple(c - total if c < _INF else c for c in end)
    for i in range(hi - 1, lo - 1, -1):
        costs, shift = _backward_step(costs, symbols[i])
        total += shift
    return tuple(c + total if c < _INF else c for c in costs)


def only(state: int):
    return tuple(0 if s == state else _INF for s in range(4))


def solve(symbols, start: int, end=_LAST) -> tuple[list[str], int, int]:
    """(edits of every row with the inserts before them, state after them, cost); ``end``
    is the cost that follows, by that state."""
    if not len(symbols):
        return [], start, end[start]
    out: list[str] = []

    def part(lo, hi, start, end):
        if hi - lo == 1:
            c, word, y = min((w[0] + end[y], w[1], y) for y, w in enumerate(STEPS[symbols[lo]][start])
                             if w and end[y] < _INF)
            out.append(word)
            return y, c
        mid = (lo + hi) // 2
        costs, ranks = forward(symbols, lo, mid, start)
        rest = backward(symbols, mid, hi, end)
        s = min((s for s in range(4) if costs[s] < _INF and rest[s] < _INF), key=lambda s: (costs[s] + rest[s], ranks[s]))
        part(lo, mid, start, only(s))
        return part(mid, hi, s, end)[0], costs[s] + rest[s]

    state, cost = part(0, len(symbols), start, end)
    return out, state, cost


def crossings(summaries) -> list[int]:
    """States between stretches: ``summaries`` holds, per stretch, (costs, ranks) from
    each start.  Returns the state before each stretch and after the last one."""
    steps = [[[(c[y], r[y]) if c[y] < _INF else None for y in range(4)] for c, r in s] for s in summaries]
    out = [START] * (len(steps) + 1)

    def part(lo, hi, end):
        mid = max(lo + 1, (lo + hi) // 2)
        costs, ranks = only(out[lo]), (0,) * 4
        for i in range(lo, mid):
            costs, ranks = choose(costs, ranks, steps[i])
        rest = end
        for i in range(hi - 1, mid - 1, -1):
            rest = tuple(min((w[0] + rest[y] for y, w in enumerate(row) if w and rest[y] < _INF), default=_INF)
                         for row in steps[i])
        out[mid] = min((s for s in range(4) if costs[s] < _INF and rest[s] < _INF),
                       key=lambda s: (costs[s] + rest[s], ranks[s]))
        if hi - lo > 1:
            part(lo, mid, only(out[mid]))
            part(mid, hi, end)

    part(0, len(steps), _LAST)
    return out


def read(role: str, text: str, seen: bool) -> tuple[int, str]:
    """(symbol, fault) of a row."""
    body = text.rstrip(SPACE)
    fault = "blank" if not body else "duplicate" if seen else "" if body[-1] in ".!?" else "truncated"
    return symbol(role, fault in ("blank", "duplicate"), fault == "truncated"), fault


def edited(rows, words, state: int, last: bool) -> tuple[str, list[tuple[str, str]]]:
    """(audit, turns that stay) of rows (role, text) from the state before them; ``last``:
    the conversation ends here."""
    turns = []

    def insert():
        nonlocal state
        turns.append(("assistant" if state == USER else "user", ""))
        state = _AFTER_INSERT[state]

    for (role, text), word in zip(rows, words, strict=True):
        for _ in word[:-1]:
            insert()
        if word[-1] == "K":
            turns.append((role, text))
            state = SYSTEM if role[:1] == "s" else _AFTER_INSERT[state]
        elif word[-1] == "R":
            turns.append(("assistant" if state == USER else "user", text))
            state = _AFTER_INSERT[state]
    more = _ENDING[state] if last else 0
    for _ in range(more):
        insert()
    return "".join(words) + "I" * more, turns


def _legal(a: str, b: str) -> bool:
    return a[:1] + b[:1] in ("su", "ua", "au")


# --- on Spark -------------------------------------------------------------------------

_TURNS = "array<struct<role:string,text:string>>"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TURNS_TYPE = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _turns(all_turns):
    return pa.array([None if turns is None else [{"role": r, "text": t} for r, t in turns] for turns in all_turns],
                    _TURNS_TYPE)


def _groups(rows, n: int):
    """Runs of rows that agree in their first n fields."""
    held, key = [], None
    for r in rows:
        if held and r[:n] != key:
            yield key, held
            held = []
        key = r[:n]
        held.append(r)
    if held:
        yield key, held


def _stream(batches):
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns], strict=True)


def _batches(records, schema: pa.Schema, rows: int = 2048, chars: int = 1 << 24, size=lambda r: 0):
    held, total = [], 0
    for r in records:
        held.append(r)
        total += size(r)
        if len(held) == rows or total > chars:
            yield _batch(held, schema)
            held, total = [], 0
    if held:
        yield _batch(held, schema)


def _batch(held, schema):
    return pa.RecordBatch.from_arrays(
        [_turns(c) if f.type == _TURNS_TYPE else pa.array(c, f.type)
         for f, c in zip(schema, zip(*held, strict=True), strict=True)], schema=schema)


def whole(rows) -> tuple:
    """(counts by ``_COUNTS``, audit, turns) of one conversation's (turn, role, text)."""
    seen, faults, symbols = set(), dict.fromkeys(("blank", "duplicate", "truncated", ""), 0), []
    for _, role, text in rows:
        sym, fault = read(role, text, (role, text) in seen)
        seen.add((role, text))
        faults[fault] += 1
        symbols.append(sym)
    words, _, cost = solve(symbols, START)
    audit, turns = edited([r[1:] for r in rows], words, START, True)
    numbers = {r[0] for r in rows} - {None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    illegal = sum(not _legal(a[1], b[1]) for a, b in zip(rows, rows[1:], strict=False))
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, turns


def _inside(id_type: pa.DataType, block: int, chars: int):
    """(conv, turn, role, text, real, mid) in order -> solved conversations, and the rows
    of those that may go on in another task or are too large for one go."""
    schema = pa.schema([("conv", id_type), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()),
                        ("turns", _TURNS_TYPE), ("mid", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                        ("text", pa.string()), ("real", pa.bool_())])
    blank = (None,) * (len(_COUNTS) + 2)

    def raw(r):
        return (r[0], *blank, r[5], r[1], r[2], r[3], r[4])

    def records(batches):
        held, key, size, first, passing = [], None, 0, True, True
        for r in _stream(batches):
            if key is None or r[0] != key[0]:
                if held:
                    yield (key[0], *whole([x[1:4] for x in held if x[4]]), *(None,) * 5)
                passing, first = first, False
                held, key, size = [], (r[0],), 0
            if not passing:
                held.append(r)
                size += len(r[3])
                if len(held) > block or size > chars:
                    passing = True
                    yield from map(raw, held)
                    held = []
            else:
                yield raw(r)
        yield from map(raw, held)

    def run(batches):
        yield from _batches(records(batches), schema, size=lambda r: len(r[-2] or "") + sum(len(t) for _, t in r[8] or ()))
    return run, schema


def _summary(id_type):
    schema = pa.schema([("conv", id_type), ("part", pa.int64()), ("costs", pa.list_(pa.int64())),
                        ("ranks", pa.list_(pa.int64())), ("blank", pa.int64()), ("duplicate", pa.int64()),
                        ("truncated", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string())])

    def records(batches):
        # (conv, part, mid, role, text, new)
        for (conv, part), rows in _groups(_stream(batches), 2):
            got = [read(role, text, not new) for *_, role, text, new in rows]
            symbols, faults = [s for s, _ in got], [f for _, f in got]
            ways = [forward(symbols, 0, len(symbols), s) for s in range(4)]
            illegal = sum(not _legal(a[3], b[3]) for a, b in zip(rows, rows[1:], strict=False))
            yield (conv, part, [c for w in ways for c in w[0]], [r for w in ways for r in w[1]],
                   *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal,
                   rows[0][3][:1], rows[-1][3][:1])
    return lambda batches: _batches(records(batches), schema), schema


def _cross(id_type):
    schema = pa.schema([("conv", id_type), ("part", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                        *[(c, pa.int64()) for c in _COUNTS[1:]]])

    def records(batches):
        for _, parts in _groups(_stream(batches), 1):
            ways = [[(tuple(p[2][4 * s:4 * s + 4]), tuple(p[3][4 * s:4 * s + 4])) for s in range(4)] for p in parts]
            states = crossings(ways)
            cost = sum(w[a][0][b] for w, a, b in zip(ways, states, states[1:], strict=False)) + _LAST[states[-1]]
            seams = sum(not _legal(a[9], b[8]) for a, b in zip(parts, parts[1:], strict=False))
            for i, p in enumerate(parts):
                last = i == len(parts) - 1
                yield (p[0], p[1], states[i], None if last else states[i + 1], *p[4:7],
                       p[7] + (seams if last else 0), cost if last else 0)
    return lambda batches: _batches(records(batches), schema), schema


def _apart(id_type):
    schema = pa.schema([("conv", id_type), ("part", pa.int64()), ("audit", pa.string()), ("turns", _TURNS_TYPE)])

    def records(batches):
        # (conv, part, mid, role, text, new, start, end), the stretch's states first
        for (conv, part), rows in _groups(_stream(batches), 2):
            (*_, start, end), rows = rows[0], rows[1:]
            symbols = [read(r[3], r[4], not r[5])[0] for r in rows]
            words, _, _ = solve(symbols, start, _LAST if end is None else only(end))
            yield (conv, part, *edited([r[3:5] for r in rows], words, start, end is None))
    return lambda batches: _batches(records(batches), schema, rows=1), schema


def _digest(id_type):
    schema = pa.schema([("conv", id_type), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def records(batches):
        key, audit, digest, empty = None, [], None, True
        for conv, _, more, turns in _stream(batches):
            if key is None or key[0] != conv:
                if key is not None:
                    yield key[0], "".join(audit), digest.hexdigest()
                key, audit, digest, empty = (conv,), [], hashlib.sha256(), True
            audit.append(more)
            for t in turns:
                digest.update((("" if empty else "\n") + t["role"] + ":" + t["text"]).encode())
                empty = False
        if key is not None:
            yield key[0], "".join(audit), digest.hexdigest()
    return lambda batches: _batches(records(batches), schema), schema


def _ddl(schema: pa.Schema, id_ddl: str) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean",
             _TURNS_TYPE: _TURNS, pa.list_(pa.int64()): "array<bigint>"}
    return ", ".join(f"{f.name} {id_ddl if f.name == 'conv' else names[f.type]}" for f in schema)


class Repaired:
    """Result of ``repair``.

    ``parts``: conv, part, audit, turns -- the repaired conversation in stretches, by part;
    ``report``: one row per conversation with its counts, audit and digest.
    """

    def __init__(self, parts: DataFrame, report: DataFrame):
        self.parts, self.report = parts, report


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", real: Column | None = None, block: int = BLOCK, chars: int = CHARS) -> Repaired:
    """Repair every conversation of ``rows``.  Rows for which ``real`` is false only say
    that their conversation exists."""
    from pyspark.sql.pandas.types import to_arrow_type

    space = F.lit(" ")
    rows = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                       F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"),
                       F.coalesce(F.lit(True) if real is None else real, F.lit(False)).alias("real"))
    id_type = to_arrow_type(rows.schema["conv"].dataType)
    ddl = rows.schema["conv"].dataType.simpleString()
    order = ["conv", "turn", "role", "head", "h"]
    # copies of one row may fall into any task: the draw parts them
    keyed = (rows.withColumn("head", F.substring("text", 1, 64)).withColumn("h", F.xxhash64("text"))
             .withColumn("draw", F.rand(13)))
    dealt = (keyed.repartitionByRange(*order, "draw").sortWithinPartitions(*order, "draw")
             .select("conv", "turn", "role", "text", "real", F.monotonically_increasing_id().alias("mid")))
    run, schema = _inside(id_type, block, chars)
    first = materialise(dealt.mapInArrow(run, _ddl(schema, ddl)), "conversations")
    done = first.where("audit IS NOT NULL").select("conv", *_COUNTS, "audit", "turns")

    cut = first.where("audit IS NULL").select("conv", "mid", "turn", "role", "text", "real")
    live = cut.where("real")
    news = live.groupBy("conv", "role", "text").agg(F.min("mid").alias("low")).select("low")
    marked = (live.join(news, live.mid == news.low, "left")
              .select("conv", F.floor(F.col("mid") / block).cast("long").alias("part"), "mid", "role", "text",
                      F.col("low").isNotNull().alias("new")))
    marked = materialise(marked, "stretches")
    run, schema = _summary(id_type)
    ways = (marked.repartition("conv", "part").sortWithinPartitions("conv", "part", "mid")
            .mapInArrow(run, _ddl(schema, ddl)))
    run, schema = _cross(id_type)
    states = materialise(ways.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(run, _ddl(schema, ddl)),
                         "crossings")
    run, schema = _apart(id_type)
    none = F.lit(None)
    both = (states.select("conv", "part", F.lit(-1).cast("long").alias("mid"), none.cast("string").alias("role"),
                          none.cast("string").alias("text"), none.cast("boolean").alias("new"), "start", "end")
            .unionByName(marked.withColumns({"start": none.cast("int"), "end": none.cast("int")})))
    apart = materialise(both.repartition("conv", "part").sortWithinPartitions("conv", "part", "mid")
                        .mapInArrow(run, _ddl(schema, ddl)), "apart")
    run, schema = _digest(id_type)
    digest = apart.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(run, _ddl(schema, ddl))

    # of conversations that were cut: sums over stretches, and the turns that are missing
    turns = (cut.groupBy("conv", F.when(F.col("real"), F.col("turn")).alias("turn")).agg(F.lit(1).alias("one"))
             .groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")))
    sums = states.groupBy("conv").agg(*[F.sum(c).alias(c) for c in _COUNTS[1:]])
    long_ones = turns.alias("t").join(sums.alias("s"), F.expr("t.conv <=> s.conv"), "left").join(
        digest.alias("d"), F.expr("t.conv <=> d.conv"), "left").select(
        "t.conv", "t.gaps", *[F.coalesce(F.col(f"s.{c}"), F.lit(0)).alias(c) for c in _COUNTS[1:]],
        F.coalesce("d.audit", F.lit("")).alias("audit"),
        F.coalesce("d.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    short = done.select("conv", *_COUNTS, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    parts = done.select("conv", F.lit(0).cast("long").alias("part"), "audit", "turns").unionByName(apart)
    return Repaired(parts, short.unionByName(long_ones))


def damage(rows: DataFrame) -> tuple[DataFrame, Column]:
    """(damaged rows of a table of conversations, whether a row is still there): by the
    crc32 of ``conv_id:turn`` modulo 20, 0 drops the row, 1 empties its text, 2 takes its
    sentence ends, 3 repeats it, 4 makes its role user.  Nulls count as one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    k = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), space)
    rows = rows.select("conv_id", "turn", F.when(k == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
                       F.when(k <= 1, F.lit("")).when(k == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                       k.alias("damage"))
    rows = rows.withColumn("copy", F.explode(F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows, F.col("damage") != 0

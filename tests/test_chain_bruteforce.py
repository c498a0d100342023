"""The whole batch chain against a plain-Python brute force on random logs with
revisions, NULL values, missing sides and missing sun reports."""

from __future__ import annotations

import datetime as dt
import random

from helpers import PRECIPITATION, SUNRISE, SUNSET, TEMPERATURE, UV_INDEX, frame
from shoreline.plans.beach import Chain

BASE = dt.datetime(2024, 3, 1)


def _logs(seed: int):
    rng = random.Random(seed)
    cities = ["A", "B", "C"]
    off = 0
    temp, prec, uv, rise, sets = [], [], [], [], []
    for _ in range(900):
        off += 1
        c = rng.choice(cities)
        h = BASE + dt.timedelta(hours=rng.randrange(0, 24 * 2))
        kind = rng.random()
        if kind < 0.35:
            temp.append((off, c, h, None if rng.random() < 0.05 else rng.choice([18.0, 20.0, 20.5, 25.0, 25.0, 25.0])))
        elif kind < 0.65:
            prec.append((off, c, h, None if rng.random() < 0.05 else rng.choice([10.0, 10.0, 29.0, 30.0, 60.0])))
        elif kind < 0.95:
            uv.append((off, c, h, None if rng.random() < 0.05 else rng.choice([1.0, 1.0, 4.9, 5.0, 8.0])))
        else:
            day = BASE + dt.timedelta(days=rng.randrange(0, 2))
            if rng.random() < 0.5:
                rise.append((off, c, day + dt.timedelta(hours=6, minutes=rng.choice([0, 10, 50]))))
            else:
                sets.append((off, c, day + dt.timedelta(hours=17, minutes=rng.choice([0, 20, 40]))))
    return temp, prec, uv, rise, sets


def _latest(rows, key):
    best = {}
    for r in rows:
        k = key(r)
        if k not in best or r[0] > best[k][0]:
            best[k] = r
    return best


def _expected(temp, prec, uv, rise, sets):
    lt = _latest(temp, lambda r: (r[1], r[2]))
    lp = _latest(prec, lambda r: (r[1], r[2]))
    lu = _latest(uv, lambda r: (r[1], r[2]))
    lr = _latest(rise, lambda r: (r[1], r[2].date()))
    ls = _latest(sets, lambda r: (r[1], r[2].date()))
    hours = {}
    for k in lt.keys() & lp.keys() & lu.keys():
        t, p, u = lt[k][3], lp[k][3], lu[k][3]
        if None in (t, p, u):
            continue
        d = (k[0], k[1].date())
        if d not in lr or d not in ls:
            continue
        is_day = lr[d][2] < k[1] < ls[d][2]
        hours[k] = (is_day, t > 20 and u < 5 and p < 30)
    groups: dict = {}
    for (c, h), (is_day, good) in hours.items():
        if good:
            groups.setdefault((c, h.date(), is_day), []).append(h)
    periods = set()
    for (c, d, is_day), hs in groups.items():
        hs.sort()
        start = prev = hs[0]
        for h in hs[1:] + [None]:
            if h is not None and h == prev + dt.timedelta(hours=1):
                prev = h
                continue
            periods.add((c, d, is_day, start, prev + dt.timedelta(minutes=59)))
            if h is not None:
                start = prev = h
    return hours, periods


def test_chain_matches_bruteforce(spark):
    for seed in (1, 2):
        temp, prec, uv, rise, sets = _logs(seed)
        chain = Chain(frame(spark, TEMPERATURE, temp), frame(spark, PRECIPITATION, prec),
                      frame(spark, UV_INDEX, uv), frame(spark, SUNRISE, rise),
                      frame(spark, SUNSET, sets))
        hours, periods = _expected(temp, prec, uv, rise, sets)
        assert sum(good for _, good in hours.values()) >= 10   # the case is not trivial
        assert any(p[4] - p[3] > dt.timedelta(hours=1) for p in periods)
        got_hours = {(r["local"], r["hora"]): (r["isDay"], r["boaHora"])
                     for r in chain.beach_hour().collect()}
        assert got_hours == hours
        for method in ("islands", "array", "session"):
            got = {(r["local"], r["dia"], r["isDay"], r["inicio"], r["fim"])
                   for r in chain.beach_day(method=method).collect()}
            assert got == periods, method

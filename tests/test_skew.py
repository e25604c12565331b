"""Hot-key inputs (one customer holds a third of the rows) against brute force.

The brute force is plain Python over the same rows, written from the report
definitions (per-day groups, running totals, ranking), independent of the
Spark plans.
"""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal as D

import pytest

from conftest import rows
from customer360 import operators as ops
from customer360.config import ReportParams
from test_traps import PLAYS, TX

ASOF = dt.date(2001, 8, 1)
P = ReportParams(asof=ASOF, vip_min_amount=5000, vip_min_count=40)


def skewed_tx(seed, n=3000):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        client = 1 if i % 3 == 0 else rnd.randint(2, 60)  # customer 1: a third of all rows
        out.append((i, client, f"login{rnd.randint(0, 2)}", ASOF - dt.timedelta(days=rnd.randint(-3, 200)),
                    rnd.choice(["Approved", "ApprovedManually", "Pending"]), rnd.choice([1, 2]), 0,
                    D(rnd.randint(-2000, 30000)) / 100))
    return out


def brute_flows(data, p):
    by_client = defaultdict(list)
    for r in data:
        if r[4] in p.approved_statuses and r[5] in (p.deposit_type, p.withdrawal_type):
            by_client[r[1]].append(r)
    out = {}
    for c, rs in by_client.items():
        res = {}
        for prefix, t in (("deposit", p.deposit_type), ("withdrawl", p.withdrawal_type)):
            mine = [r for r in rs if r[5] == t]
            for n in p.horizons:
                res[f"{prefix}_{n}_days"] = (float(sum((r[7] for r in mine if (ASOF - r[3]).days <= n), D(0)))
                                             if mine else None)
            res[f"{prefix}_lifetime"] = float(sum((r[7] for r in mine), D(0))) if mine else None
        # VIP date: running totals over days (logins of a day together).
        days = defaultdict(lambda: [D(0), set()])
        for r in rs:
            if r[5] == p.deposit_type:
                days[r[3]][0] += r[7]
                days[r[3]][1].add((r[2], r[0]))
        amt, cnt, vip = D(0), 0, None
        for d in sorted(days):
            amt += days[d][0]
            cnt += len(days[d][1])
            if vip is None and (amt >= p.vip_min_amount or cnt >= p.vip_min_count):
                vip = d
        res["vip_date"] = vip
        out[c] = res
    return out


@pytest.mark.parametrize("seed", [11, 12])
def test_flow_summary_under_skew(spark, seed):
    data = skewed_tx(seed)
    df = spark.createDataFrame(data, TX).repartition(6)
    got = {r["client_id"]: r.asDict() for r in ops.flow_summary(df, P).collect()}
    exp = brute_flows(data, P)
    assert set(got) == set(exp)
    for c, e in exp.items():
        for k, v in e.items():
            assert got[c][k] == v, (c, k, got[c][k], v)


def brute_top(data, horizon):
    sums = defaultdict(lambda: None)
    seen = set()
    for c, pv, pr, n, day in data:
        if horizon is not None and (day is None or (ASOF - day).days > horizon):
            continue
        seen.add((c, pv, pr))
        if n is not None:
            sums[(c, pv, pr)] = (sums[(c, pv, pr)] or 0) + n
    best = {}
    for c, pv, pr in seen:
        b = sums[(c, pv, pr)]
        key = (b is not None, -(b or 0), pv, pr)
        if c not in best or key < best[c][0]:
            best[c] = (key, pv, pr, b)
    return sorted(((c, v[1], v[2], v[3]) for c, v in best.items()), key=repr)


@pytest.mark.parametrize("horizon", [None, 7, 30])
def test_top_product_under_skew(spark, horizon):
    rnd = random.Random(5)
    data = []
    for i in range(4000):
        c = 1 if i % 3 == 0 else rnd.randint(2, 40)
        n = None if rnd.random() < 0.02 else rnd.randint(0, 9)
        day = None if rnd.random() < 0.01 else ASOF - dt.timedelta(days=rnd.randint(-2, 120))
        data.append((c, f"P{rnd.randint(0, 3)}", f"G{rnd.randint(0, 25)}", n, day))
    df = spark.createDataFrame(data, PLAYS).repartition(5)
    h = "lft" if horizon is None else horizon
    assert rows(ops.top_product(df, P, h)) == brute_top(data, horizon)

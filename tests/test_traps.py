"""Trap tests on small inline frames: the semantics that are easy to get wrong."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from customer360 import operators as ops
from customer360.config import ReportParams
from customer360.functions import eur_text, round2, whole_units
from customer360.plans.joins import null_safe_left_join, suffix_overlaps

ASOF = dt.date(2001, 8, 1)
P = ReportParams(asof=ASOF, vip_min_amount=100, vip_min_count=3, crossing_amount=100)

TX = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("client_id", T.LongType()),
    T.StructField("user_name", T.StringType()), T.StructField("txn_date", T.DateType()),
    T.StructField("status", T.StringType()), T.StructField("txn_type", T.IntegerType()),
    T.StructField("currency_fk", T.LongType()), T.StructField("amount", T.DecimalType(18, 2)),
])
DAYS = T.StructType([
    T.StructField("client_id", T.LongType()), T.StructField("summary_day", T.DateType()),
    T.StructField("bet_amount", T.DecimalType(12, 2)), T.StructField("bets_count", T.LongType()),
    T.StructField("ggr", T.DecimalType(17, 4)), T.StructField("ngr", T.DecimalType(17, 4)),
    T.StructField("returns_amount", T.DecimalType(17, 4)),
])
PLAYS = T.StructType([
    T.StructField("client_id", T.LongType()), T.StructField("provider_name", T.StringType()),
    T.StructField("product_name", T.StringType()), T.StructField("played_count", T.LongType()),
    T.StructField("summary_day", T.DateType()),
])
RATES = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("rate_to_eur", T.DecimalType(10, 3)),
    T.StructField("is_valid", T.IntegerType()),
])


def day(n):
    """The day ``n`` days before ASOF (negative: after)."""
    return ASOF - dt.timedelta(days=n)


def tx(spark, data):
    return spark.createDataFrame(
        [(i, c, u, day(d), s, t, cur, D(a) if a is not None else None) for i, c, u, d, s, t, cur, a in data], TX
    )


def rates(spark, data):
    return spark.createDataFrame([(i, None if r is None else D(r), v) for i, r, v in data], RATES)


# -- horizons -----------------------------------------------------------------

def test_horizon_is_inclusive_and_lets_future_rows_in(spark):
    df = tx(spark, [
        (1, 1, "a", 7, "Approved", 2, 1, "10.00"),     # exactly 7 days: in the 7-day horizon
        (2, 1, "a", 8, "Approved", 2, 1, "20.00"),     # 8 days: only from 14 on
        (3, 1, "a", -3, "Approved", 2, 1, "5.00"),     # future: passes every horizon
        (4, 1, "a", 1, "Pending", 2, 1, "1000.00"),    # not approved
    ])
    r = ops.deposit_horizons(df, P).collect()[0]
    assert r["deposit_7_days"] == 15.0
    assert r["deposit_14_days"] == 35.0
    assert r["deposit_lifetime"] == 35.0
    assert r["total_deposits_count"] == 3
    assert (r["days_since_last_deposit"], r["days_since_first_deposit"]) == (-3, 8)


def test_horizon_zero_not_null_when_rows_exist_outside(spark):
    r = ops.deposit_horizons(tx(spark, [(1, 1, "a", 100, "Approved", 2, 1, "10.00")]), P).collect()[0]
    assert r["deposit_7_days"] == 0.0 and r["deposit_lifetime"] == 10.0


def test_combined_flows_keep_kinds_apart(spark):
    df = tx(spark, [(1, 1, "a", 1, "Approved", 2, 1, "10.00"), (2, 2, "a", 1, "Approved", 1, 1, "7.00")])
    got = {r["client_id"]: r for r in ops.flow_horizons(df, P).collect()}
    assert got[1]["withdrawl_lifetime"] is None and got[1]["withdrawl_count"] is None
    assert got[2]["deposit_lifetime"] is None and got[2]["total_deposits_count"] is None
    assert got[2]["withdrawl_7_days"] == 7.0


# -- running totals and VIP rules ------------------------------------------------

def test_range_frame_peers_share_running_total(spark):
    df = tx(spark, [
        (1, 1, "login0", 5, "Approved", 2, 1, "60.00"),
        (2, 1, "login1", 5, "Approved", 2, 1, "50.00"),  # same day, other login
        (3, 1, "login0", 4, "Approved", 2, 1, "1.00"),
    ])
    cum = {(r["user_name"], r["txn_date"]): r for r in ops.cumulative_flow(df, P).collect()}
    assert cum[("login0", day(5))]["cumulative_dpst_amt"] == 110.0
    assert cum[("login1", day(5))]["cumulative_dpst_amt"] == 110.0
    assert cum[("login0", day(4))]["cumulative_dpst_count"] == 3
    # 110 >= 100 is reached on day 5 only because both logins count together.
    assert rows(ops.qualification_date(df, P)) == [(1, day(5))]


def test_running_count_uses_distinct_ids(spark):
    df = tx(spark, [(7, 1, "a", 3, "Approved", 2, 1, "1.00")] * 3 + [(8, 1, "a", 2, "Approved", 2, 1, "1.00")])
    c = {r["txn_date"]: r["cumulative_dpst_count"] for r in ops.cumulative_flow(df, P).collect()}
    assert c == {day(3): 1, day(2): 2}


def brute_running(data, p):
    """(client, login, day) -> amount, count, running amount, running distinct ids; NULL days last."""
    groups = {}
    for i, c, u, d, s, t, _, a in data:
        if s in p.approved_statuses and t == p.deposit_type:
            g = groups.setdefault((c, u, d), [[], []])
            g[0].append(a)
            g[1].append(i)
    out = {}
    for c, u, d in groups:
        upto = [v for (c2, _, d2), v in groups.items() if c2 == c and (d is None or (d2 is not None and d2 <= d))]
        out[(c, u, d)] = (float(sum(groups[(c, u, d)][0])), sum(i is not None for i in groups[(c, u, d)][1]),
                          float(sum(sum(v[0]) for v in upto)), sum(len({i for i in v[1] if i is not None}) for v in upto))
    return out


@pytest.mark.parametrize("id_type", ["bigint", "int", "string", "decimal(20,0)"])
@pytest.mark.parametrize("repeats", [0.0, 0.3])
def test_running_distinct_ids(spark, id_type, repeats):
    """Ids that repeat inside a day, across days, logins and customers; NULL, negative and undated ones."""
    import random

    rng = random.Random(int(repeats * 10) + len(id_type))
    data = []
    for k in range(700):
        i = None if rng.random() < 0.05 else rng.randrange(-40, 60) if rng.random() < repeats else 10_000 + 3 * k
        data.append((i, 1 if k % 3 == 0 else rng.randrange(8), rng.choice(["a", "b", None]), None if rng.random() < 0.05 else day(rng.randrange(20)),
                     rng.choice(["Approved", "Pending"]), rng.choice([1, 2, 2]), 1, D(rng.randrange(100, 900)) / 100))
    if repeats:  # one id on a day of one login, of two logins, of two customers, and on two days
        data += [(5, c, u, d, "Approved", 2, 1, D("1.50")) for c, u, d in ((1, "a", day(3)), (1, "a", day(3)), (1, "b", day(3)), (2, "a", day(3)), (1, "a", day(4)))]
    t = spark.createDataFrame(data, TX).withColumn("id", F.col("id").cast(id_type)).repartition(6)
    want = brute_running(data, P)
    got = {(r["client_id"], r["user_name"], r["txn_date"]): tuple(r)[4:] for r in ops.cumulative_flow(t, P).collect()}
    assert got == want
    first = {}
    for (c, _, d), v in want.items():
        if v[2] >= P.vip_min_amount or v[3] >= P.vip_min_count:
            first.setdefault(c, []).append(d)
    vip = {c: min((d for d in ds if d is not None), default=None) for c, ds in first.items()}
    assert dict(rows(ops.qualification_date(t, P))) == vip
    summary = ops.flow_summary(t, P)
    assert {r["client_id"]: r["vip_date"] for r in summary.collect() if r["client_id"] in vip} == vip
    assert rows(ops.flow_summary(t, P, daily=ops.flow_daily(t, P))) == rows(summary)
    assert ops.flow_daily(t, P).groupBy("client_id", "txn_date").count().where("count > 1").isEmpty()
    days = {d for d in {x[3] for x in data} if len(ids := [x[0] for x in data if x[3] == d and x[0] is not None and x[4] == "Approved" and x[5] == 2]) > len(set(ids))}
    found = ops.repeated_id_days(ops.filter_approved(t, P, P.deposit_type))
    assert {r["txn_date"] for r in found.collect()} == days and bool(days) == (repeats > 0)


def test_two_vip_rules_differ_with_negative_amounts(spark):
    df = tx(spark, [(1, 1, "a", 5, "Approved", 2, 1, "150.00"), (2, 1, "a", 4, "Approved", 2, 1, "-100.00")])
    assert rows(ops.qualification_date(df, P)) == [(1, day(5))]   # running total crossed 100 once
    assert ops.vip_cohort(df, P).count() == 0                       # lifetime 50 < 100, 2 deposits < 3


# -- division -------------------------------------------------------------------

def _days(spark, data):
    return spark.createDataFrame(
        [(c, day(d), D(b), n, D(g), D(ng), D(rt)) for c, d, b, n, g, ng, rt in data], DAYS
    )


def test_zero_denominators_give_null(spark):
    df = _days(spark, [(1, 1, "10.00", 0, "1", "1", "5")])
    r = ops.avg_bet_horizons(df, P).collect()[0]
    assert r["avg_bet_7_days"] is None
    df2 = _days(spark, [(1, 1, "0.00", 0, "1", "1", "5")])
    assert ops.payout_percent(df2).collect()[0]["payout_percent"] is None


def test_kpi_ratios_null_semantics(spark):
    wide = spark.createDataFrame(
        [(1, 10.0, 0.0, 5.0, None)], "client_id long, ngr_7_days double, deposit_7_days double, "
        "deposit_lifetime double, withdrawl_lifetime double",
    )
    p = ReportParams(asof=ASOF, horizons=(7,))
    r = ops.kpi_ratios(wide, p).collect()[0]
    assert r["ngr_deposits_7_days"] is None          # x / 0
    assert r["deposit_payout_percent"] is None       # NULL / x
    assert r["net_deposits"] is None                 # no zero fill


# -- top product ----------------------------------------------------------------

def _plays(spark, data):
    return spark.createDataFrame([(c, pv, pr, n, day(d) if d is not None else None) for c, pv, pr, n, d in data],
                                 PLAYS)


def test_top_product_ties_nulls_and_horizons(spark):
    df = _plays(spark, [
        (1, "B", "x", 5, 1), (1, "A", "y", 5, 1),       # tie: provider A wins
        (2, "A", "p", 9, 1), (2, "A", "q", None, 2),     # NULL plays rank first (descending, nulls first)
        (3, "A", "old", 50, 100), (3, "A", "new", 1, 3),  # 7-day horizon ignores the old product
        (4, "A", "undated", 99, None),                   # NULL day: lifetime only
    ])
    top = {r["client_id"]: r for r in ops.top_products(df, P).collect()}
    assert (top[1]["top_provider_lft"], top[1]["top_played_game_lft"]) == ("A", "y")
    assert top[2]["top_played_game_lft"] == "q" and top[2]["bets_on_top_game_lft"] is None
    assert top[3]["top_played_game_lft"] == "old" and top[3]["top_played_game_7d"] == "new"
    assert top[4]["top_played_game_lft"] == "undated" and top[4]["top_played_game_7d"] is None
    assert ops.top_product(df, P, 7).filter("client_id = 4").count() == 0


def test_reference_compat_reuses_7_day_bets(spark):
    cust = spark.createDataFrame(
        [(1, "u1@example.test", "F", "L", "9", "NL", 1, dt.date(1980, 1, 1), 1, 1, dt.date(2000, 1, 1),
          day(1), "S")],
        "id long, email string, first_name string, last_name string, mobile_number string, "
        "country_name string, language_fk int, birth_date date, affiliate_id long, partner_id long, "
        "created_on date, last_session_on date, state_name string",
    )
    t = tx(spark, [(1, 1, "a", 1, "Approved", 2, 1, "500.00")])
    d = _days(spark, [(1, 1, "10.00", 1, "1", "1", "5")])
    pl = _plays(spark, [(1, "A", "recent", 2, 1), (1, "A", "month", 40, 20)])
    a = ops.report_a(cust, t, d, pl, P).collect()[0]
    assert (a["bets_on_top_game_7d"], a["bets_on_top_game_30d"]) == (2, 40)
    compat = ReportParams(asof=ASOF, vip_min_amount=100, vip_min_count=3, reference_compat=True)
    b = ops.report_a(cust, t, d, pl, compat).collect()[0]
    assert (b["top_played_game_30d"], b["bets_on_top_game_30d"]) == ("month", 2)
    assert len(ops.report_a(cust, t, d, pl, P).columns) == 63


# -- currencies -----------------------------------------------------------------

def test_rate_rules_fan_out_and_valid_distinct(spark):
    t = tx(spark, [(1, 1, "a", 1, "Approved", 2, 3, "10.00"), (2, 1, "a", 1, "Approved", 2, 9, "10.00"),
                   (3, 1, "a", 1, "Approved", 2, 7, "10.00")])
    r = spark.createDataFrame([(3, D("0.500"), 1), (3, D("4.000"), 0), (3, D("0.500"), 1), (7, D("0"), 1)], RATES)
    all_rows = ops.fx_normalise(t, r, P)
    assert all_rows.filter("id = 1").count() == 3          # every rate row joins
    assert all_rows.filter("id = 2").collect()[0]["amount_eur"] is None   # no rate
    assert all_rows.filter("id = 3").collect()[0]["amount_eur"] is None   # zero rate
    valid = ops.fx_normalise_valid(t, r, P)
    assert [float(x["amount_eur"]) for x in valid.filter("id = 1").collect()] == [20.0]


def test_case_rate_table(spark):
    df = spark.createDataFrame([("CAD",), ("GBP",), ("JPY",), (None,)], "currency_id string")
    got = {r[0]: r[1] for r in ops.currency_case_rate(df).collect()}
    assert got == {"CAD": 0.67, "GBP": 1.18, "JPY": 1.0, None: 1.0}


# -- balances, bonuses ----------------------------------------------------------

def test_latest_balance_keeps_ties(spark):
    b = spark.createDataFrame(
        [(1, day(2), D("5.00")), (1, day(1), D("7.00")), (1, day(1), D("8.00")), (2, day(9), D("1.00"))],
        "client_id long, summary_day date, balance decimal(18,2)",
    )
    assert rows(ops.latest_balance(b)) == [(1, 7.0), (1, 8.0), (2, 1.0)]


def test_bonus_counts_and_expense_filter(spark):
    bon = spark.createDataFrame(
        [(1, 1, 0, 0, day(5), "WIN", D("10.00")), (2, 1, 0, 0, day(1), "WIN", D("10.00")),
         (3, 1, 0, 0, day(1), "WIN", D("0.00")), (4, 1, 0, 0, day(1), "LOST", D("99.00")),
         (5, 2, 0, 0, day(1), "WIN", D("10.00")), (6, 3, 0, 0, day(1), "WIN", D("-1.00"))],
        "id long, client_id long, bonus_fk long, merchant_fk long, bonus_date date, status string, "
        "winning_amount decimal(12,2)",
    )
    cust = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "id long, currency_fk long")
    rates = spark.createDataFrame([(1, D("1.000"), 1)], RATES)
    crossing = spark.createDataFrame([(1, day(3))], "client_id long, date_of_reaching_1k date")
    got = {r["client_id"]: r for r in ops.bonus_expense(bon, cust, rates, crossing, P).collect()}
    assert set(got) == {1, 2}                                  # customer 3: expense <= 0
    assert (got[1]["mkt_expense"], got[1]["bonus_count"], got[1]["vip_bonus_count"]) == (20.0, 2, 1)
    assert got[2]["vip_bonus_count"] == 0                      # no crossing date


# -- presentation -----------------------------------------------------------------

def test_money_text_and_rounding(spark):
    df = spark.createDataFrame([(1234567.89,), (-1234.99,), (None,), (0.5,), (-0.9,)], "v double")
    got = [r[0] for r in df.select(eur_text("v")).collect()]
    nb = "\u00a0"  # no-break space after the euro sign
    assert got == [f"€{nb}1.234.567,00", f"€{nb}-1.234,00", f"€{nb}0,00", f"€{nb}0,00", f"€{nb}0,00"]
    w = [r[0] for r in df.select(whole_units("v")).collect()]
    assert w == [1234567, -1234, 0, 0, 0]


def test_rounding_equals_that_of_data_frames(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(5)
    v = np.concatenate([[40153.575, 1142.785, 2.345, 0.1349999999, 0.125, 2.675, 1.005, -2.345, 0.0],
                        np.round(rng.uniform(-1e5, 1e5, 10_000), 3), rng.normal(0, 1e3, 5_000)])
    r = spark.createDataFrame(pd.DataFrame({"i": np.arange(len(v)), "v": v}))
    got = [x[0] for x in r.select("i", round2("v").alias("r")).orderBy("i").select("r").collect()]
    assert got == pd.Series(v).round(2).tolist()
    assert got[:4] == [40153.57, 1142.79, 2.35, 0.13]


def test_blocked_flag_case_sensitive_and_null(spark):
    from customer360.functions import blocked_flag

    df = spark.createDataFrame([("blocked_1@x",), ("BLOCKED@x",), (None,)], "e string")
    assert [r[0] for r in df.select(blocked_flag("e")).collect()] == [1, 0, 0]


def test_null_keys_match_and_salting_is_exact(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "z")], "k long, email string")
    right = spark.createDataFrame([("a", 10), (None, 20), (None, 21), ("b", 30)], "req string, turn long")
    got = rows(null_safe_left_join(left, right, "email", "req", group_rows=1), "k", "turn")
    assert got == [(1, 10), (2, 20), (2, 21), (3, 20), (3, 21), (4, None)]
    plain = left.join(right, left.email.eqNullSafe(right.req), "left")
    assert got == rows(plain, "k", "turn")


@pytest.mark.parametrize("a, b, group_rows", [(0, 3, 1), (3, 0, 1), (1, 1, 1), (40, 5, 7), (5, 400, 2), (300, 1, 10)])
def test_null_groups_of_every_size(spark, a, b, group_rows):
    left = spark.createDataFrame([(k, None if k < a else "e%d" % k, 1, 2) for k in range(a + 3)], "k long, email string, salt int, fan int").repartition(3)
    right = spark.createDataFrame([(None if k < b else "e%d" % (a + k - b), k, 9) for k in range(b + 2)], "req string, turn long, right_salt int").repartition(2)
    plain = left.join(right, left.email.eqNullSafe(right.req), "left")
    for sized_by in (None, left):
        out = null_safe_left_join(left, right, "email", "req", group_rows=group_rows, sized_by=sized_by)
        assert out.columns == plain.columns and rows(out) == rows(plain)


def test_bonus_columns_named_like_lookups_pass_through(spark):
    bon = spark.createDataFrame(
        [(1, 6, 0, 0, day(1), "WIN", D("8.00"), "own text", 77, "own rate", "x", "y")],
        "id long, client_id long, bonus_fk long, merchant_fk long, bonus_date date, status string, "
        "winning_amount decimal(12,2), description string, currency_fk long, rate_to_eur string, _pid string, _rate_to_eur string",
    )
    cust = spark.createDataFrame([(6, 1, 0)], "id long, currency_fk long, country_fk long")
    none = {"bonus_defs": "id long, promo_code string, description string", "merchants": "id long, name string",
            "attributes": "client_id long, referral_info string", "countries": "id long, country_desc string", "crossing": "client_id long, date_of_reaching_1k date"}
    frames = {k: spark.createDataFrame([], v) for k, v in none.items()}
    frames["bonus_defs"] = spark.createDataFrame([(0, "P", "looked up")], none["bonus_defs"])
    r = ops.bonus_enriched(bon, cust, rates(spark, [(1, "0.500", 1)]), frames["bonus_defs"], frames["merchants"], frames["attributes"],
                           frames["countries"], frames["crossing"], P).collect()[0].asDict()
    assert (r["description"], r["description_lookup"], r["currency_fk"], r["currency_fk_lookup"]) == ("own text", "looked up", 77, 1)
    assert (r["rate_to_eur"], r["rate_to_eur_lookup"], r["win_amount_euro"], r["promo_code"], r["_pid"]) == ("own rate", 0.5, 16.0, "P", "x")


@pytest.mark.parametrize("kind", ["decimal(18,2)", "decimal(38,18)", "double"])
def test_ledger_equals_its_parts(spark, kind):
    """Rates repeated, invalid, zero and missing; undated rows; both kinds; any money type."""
    import random

    rng = random.Random(4)
    data = [(i, rng.randrange(6), "a", None if rng.random() < 0.1 else day(rng.randrange(-3, 100)), rng.choice(["Approved", "Pending"]), rng.choice([1, 2, 3]),
             rng.randrange(7), None if rng.random() < 0.05 else D(rng.randrange(-500, 3000)) / 100) for i in range(400)]
    t = spark.createDataFrame(data, TX).withColumn("amount", F.col("amount").cast(kind)).repartition(4)
    r = rates(spark, [(0, "1.000", 1), (1, "0.300", 1), (1, "0.300", 1), (1, "0.300", 0), (1, "0.700", 0), (2, "0.000", 1), (3, "0.900", 0), (4, None, 1), (4, "3.000", 1), (4, "0.070", 1)])
    from customer360.operators.reports import flow_horizons_eur

    want = flow_horizons_eur(t, r, P).join(ops.threshold_crossing(t, r, P), "client_id", "left")
    got = ops.ledger(t, r, P)
    if kind == "double":  # sums of doubles depend on their order
        near = lambda x: [[pytest.approx(v, rel=1e-9) if isinstance(v, float) else v for v in row] for row in x]
        assert [list(x) for x in rows(got, *want.columns)] == near(rows(want))
    else:
        assert rows(got, *want.columns) == rows(want)
    crossed = {r["client_id"] for r in ops.threshold_crossing(t, r, P).collect()}
    assert crossed and {r["client_id"] for r in got.where("reached").collect()} == crossed == {r["client_id"] for r in ops.cohort_ledger(t, r, P).collect()}


def test_bonus_counts_beyond_a_thousand_million(spark):
    """Equal bonuses times attribute rows: more than nine digits, exact."""
    from customer360.operators.bonus import expense_columns, expense_exprs

    counted = spark.createDataFrame([(1, day(1), D("0.07"), 4_000_000_011, D("0.300"), None), (1, day(2), D("-1.00"), 3, D("0.300"), None)],
                                    "client_id long, bonus_date date, winning_amount decimal(12,2), n long, rate_to_eur decimal(10,3), date_of_reaching_1k date")
    for kind, places in (("decimal(12,2)", 6), ("decimal(38,18)", 22), ("decimal(14,5)", 9)):
        df = counted.withColumn("winning_amount", F.col("winning_amount").cast(kind))
        out = df.groupBy("client_id").agg(*expense_exprs(df, df, P))
        r = out.withColumns(expense_columns(out, df, P, F.lit(5).cast("bigint"))).first()
        each = (D("0.07") / D("0.3")).quantize(D(1).scaleb(-places))
        third = (D(-1) / D("0.3")).quantize(D(1).scaleb(-places))
        assert (r["mkt_expense"], r["bonus_count"]) == (float((each * 4_000_000_011 + third * 3) * 5), 20_000_000_055)


def test_overlapping_names_get_suffixes(spark):
    l = spark.createDataFrame([(1, "x", 5)], "k long, email string, turn long")
    r = spark.createDataFrame([("x", 6, 7)], "req string, turn long, other long")
    l2, r2 = suffix_overlaps(l, r, ["email", "req"])
    assert "turn_x" in l2.columns and "turn_y" in r2.columns and "other" in r2.columns


def test_contact_enrichment_decodes_and_drops_keys(spark):
    rep = spark.createDataFrame([(1, bytearray(b"u1@x")), (2, None)], "Customer_ID long, email binary")
    con = spark.createDataFrame([(0, "u1@x", 3), (1, None, 4)], "index long, requester_email string, n long")
    out = ops.contact_enrichment(rep, con)
    assert out.columns == ["Customer_ID", "n"]
    assert rows(out) == [(1, 3), (2, 4)]


@pytest.mark.parametrize("metric_type", ["double", "bigint"])
def test_round_metrics_leaves_counts(spark, metric_type):
    p = ReportParams(asof=ASOF, horizons=(7,))
    df = spark.createDataFrame([(1.005, 3)], "Deposit_7_days double, Total_Deposits_Count bigint")
    df = df.withColumn("Total_Deposits_Count", df["Total_Deposits_Count"].cast(metric_type))
    out = ops.round_metrics(df, p, cols=["Deposit_7_days", "Total_Deposits_Count"])
    assert out.schema["Total_Deposits_Count"].dataType == df.schema["Total_Deposits_Count"].dataType
    assert out.collect()[0] == (1.0, 3)  # the float 1.005 times 100 is just below 100.5


def test_bonus_enriched_customer_missing_from_one_table(spark):
    bon = spark.createDataFrame(
        [(1, 5, 0, 0, day(1), "WIN", D("10.00")), (2, 6, 0, 0, day(1), "WIN", D("8.00"))],
        "id long, client_id long, bonus_fk long, merchant_fk long, bonus_date date, status string, "
        "winning_amount decimal(12,2)",
    )
    cust = spark.createDataFrame([(6, 1, 0), (7, 1, 0)], "id long, currency_fk long, country_fk long")
    rates = spark.createDataFrame([(1, D("2.000"), 1), (1, D("4.000"), 0)], RATES)
    attrs = spark.createDataFrame([(5, "aff5", dt.date(2000, 1, 1))], "client_id long, referral_info string, registered_on date")
    crossing = spark.createDataFrame([(5, day(9))], "client_id long, date_of_reaching_1k date")
    defs = spark.createDataFrame([(0, "P", "promo")], "id long, promo_code string, description string")
    merch = spark.createDataFrame([(0, "M")], "id long, name string")
    ctry = spark.createDataFrame([(0, "NL")], "id long, country_desc string")
    out = ops.bonus_enriched(bon, cust, rates, defs, merch, attrs, ctry, crossing, P)
    got = rows(out, "client_id", "rate_to_eur", "win_amount_euro", "referral_info", "date_of_reaching_1k",
               "country_name", "promo_code")
    assert got == sorted([
        (5, None, None, "aff5", day(9), None, "P"),          # not in customers: attributes and crossing still found
        (6, 2.0, 4.0, None, None, "NL", "P"), (6, 4.0, 2.0, None, None, "NL", "P"),  # two rate rows: fan-out
    ], key=repr)


def test_money_sums_are_exact_at_the_declared_scale(spark):
    from customer360.functions import money_sum

    d = spark.createDataFrame([(D("0.00000040"), 0.25)] * 5, "dec decimal(18,8), dbl double")
    assert d.agg(money_sum("dec"), money_sum("dbl")).first()[:] == (0.000002, 1.25)


def test_base_currency_keeps_the_scale_of_the_amount(spark):
    tx = spark.createDataFrame([(1, 1, "u", day(1), "Approved", 2, 1, D("0.00010000"))],
                               "id long, client_id long, user_name string, txn_date date, status string, txn_type int, currency_fk long, amount decimal(18,8)")
    r = ops.fx_normalise(tx, spark.createDataFrame([(1, D("3.000"), 1)], RATES), P).first()
    assert r["amount_eur"] == D("0.000033333333")


def test_undated_deposits_sort_as_in_each_source_database(spark):
    tx = spark.createDataFrame(
        [(1, 1, "u", None, "Approved", 2, 1, D("95.00")), (2, 1, "u", dt.date(2001, 7, 1), "Approved", 2, 1, D("10.00")),
         (3, 1, "u", dt.date(2001, 7, 9), "Approved", 2, 1, D("95.00"))],
        "id long, client_id long, user_name string, txn_date date, status string, txn_type int, currency_fk long, amount decimal(18,2)")
    assert rows(ops.qualification_date(tx, P, 100, 99)) == [(1, dt.date(2001, 7, 9))]
    assert ops.flow_summary(tx, P, 100, 99).first()["vip_date"] == dt.date(2001, 7, 9)
    rates = spark.createDataFrame([(1, D("1.000"), 1)], RATES)
    assert rows(ops.threshold_crossing(tx, rates, P, 100)) == [(1, dt.date(2001, 7, 1))]
    assert rows(ops.threshold_crossing(tx, rates, P, 95)) == [(1, None)]


def test_bonus_joins_that_repeat_rows(spark):
    bon = spark.createDataFrame([(1, 1, 0, 0, day(1), "WIN", D("10.00"), "kept")],
                                "id long, client_id long, bonus_fk long, merchant_fk long, bonus_date date, status string, winning_amount decimal(12,2), extra string")
    cust = spark.createDataFrame([(1, 1, 0)], "id long, currency_fk long, country_fk long")
    rates = spark.createDataFrame([(1, D("1.000"), 1)], RATES)
    attrs = spark.createDataFrame([(1, "a", day(1)), (1, "b", day(1))], "client_id long, referral_info string, registered_on date")
    crossing = spark.createDataFrame([(1, day(3))], "client_id long, date_of_reaching_1k date")
    none = spark.createDataFrame([], "id long, promo_code string, description string, name string, country_desc string")
    rich = ops.bonus_enriched(bon, cust, rates, none.select("id", "promo_code", "description"), none.select("id", "name"), attrs,
                              none.select("id", "country_desc"), crossing, P)
    assert rows(rich, "referral_info", "win_amount_euro", "extra") == [("a", 10.0, "kept"), ("b", 10.0, "kept")]
    r = ops.bonus_expense(bon, cust, rates, crossing, P, attributes=attrs).first()
    assert (r["mkt_expense"], r["bonus_count"]) == (20.0, 2)

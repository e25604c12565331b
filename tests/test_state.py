"""Published versions, gaming state and latest balances carried over simulated days."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import rows
from customer360 import operators as ops
from customer360.config import ReportParams
from customer360.jobs import refresh_gaming_state, refresh_latest_balances
from customer360.operators import gaming_state
from customer360.operators.gaming import LIFETIME, avg_bet_exprs, last_bet_expr, payout_expr, revenue_exprs
from customer360.sources.sinks import publish, published
from customer360.sources.versions import MARKERS, Versions
from test_traps import DAYS, PLAYS, TX

FIRST = dt.date(2001, 8, 1)


def broken(spark, n=1000):
    """A frame whose write fails after some rows."""
    return spark.range(n, numPartitions=4).select(
        F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).cast("bigint").alias("Customer_ID"))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_write_that_fails_half_way_leaves_the_day(spark, tmp_path, fmt):
    root, day = str(tmp_path), dt.date(2001, 8, 1)
    assert published(spark, "report_b", root, fmt=fmt) is None
    with pytest.raises(Exception, match="lost"):
        publish(broken(spark), day, "report_b", root, fmt)
    assert published(spark, "report_b", root, ["07-31-2001"], fmt) is None
    good = spark.range(5).select(F.col("id").alias("Customer_ID"))
    publish(good, day, "report_b", root, fmt)
    for keep in (0, 2):
        with pytest.raises(Exception, match="lost"):
            publish(broken(spark), day, "report_b", root, fmt, keep=keep)
        now = published(spark, "report_b", root, fmt=fmt)
        assert rows(now.select(F.col("Customer_ID").cast("int"), "report_date")) == [(i, "07-31-2001") for i in range(5)]
    publish(good.where("Customer_ID = 3"), day, "report_b", root, fmt)
    assert [int(r[0]) for r in published(spark, "report_b", root, fmt=fmt).select("Customer_ID").collect()] == [3]
    # The versions that failed and the one before are gone.
    assert len(glob.glob(f"{root}/report_b/report_date=07-31-2001/v-*")) == 1


def test_versions_that_readers_are_at_stay(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "t"))
    assert store.current() is None and store.read() is None
    store.write(spark.range(1))
    reader = store.read()
    store.write(spark.range(2))
    assert (reader.count(), store.read().count()) == (1, 2)
    store.write(store.read().union(spark.range(5)), keep=1)  # reads the version it replaces
    assert store.read().count() == 7 and len(os.listdir(str(tmp_path / "t" / MARKERS))) <= 4  # with checksum files
    at = store.write_tables({"a": spark.range(3), "b": spark.range(4)}, keep=0)
    assert [spark.read.parquet(f"{at}/{t}").count() for t in "ab"] == [3, 4] and len(glob.glob(str(tmp_path / "t" / "v-*"))) == 1


def simulated(seed):
    """Rows with the day on which they arrive: mostly their own, some late, some without a day."""
    rng = random.Random(seed)
    days, plays = [], []
    for _ in range(900):
        arrival = FIRST + dt.timedelta(days=rng.randrange(10))
        back = rng.choice([0, 0, 0, 1, 5, 6, 7, 8, 30, 31, 84, 89, 90, 91, 95, 99, 300, -2])
        day = None if rng.random() < 0.04 else arrival - dt.timedelta(days=back)
        c = 1 if rng.random() < 0.33 else rng.randrange(2, 12)
        m = lambda lo, hi: None if rng.random() < 0.05 else D(rng.randrange(lo, hi)) / 100
        days.append((arrival, (c, day, m(0, 5000), rng.choice([None, 0, 0, 1, 7]), m(-900, 900), m(-900, 900), m(0, 4000))))
        plays.append((arrival, (c, rng.choice(["P1", "P2", None]), rng.choice(["G1", "G2", "G3"]), rng.choice([None, 0, 1, 2, 3]), day)))
    return days, plays


def test_reports_from_state_equal_those_from_scratch(spark, tmp_path):
    """Ten days, each with its arrivals: the state's metrics against all rows that arrived so far."""
    days, plays = simulated(8)
    path, seen = str(tmp_path / "state"), 0
    for k in range(10):
        asof = FIRST + dt.timedelta(days=k)
        p = ReportParams(asof=asof)
        today = [spark.createDataFrame([r for a, r in x if a == asof], s).repartition(3) for x, s in ((days, DAYS), (plays, PLAYS))]
        state = refresh_gaming_state(*today, p, path)
        seen += sum(a == asof for a, _ in days)
        if k % 3 and k != 8:
            continue
        so_far = [spark.createDataFrame([r for a, r in x if a <= asof], s) for x, s in ((days, DAYS), (plays, PLAYS))]
        want = so_far[0].groupBy("client_id").agg(*revenue_exprs(p), *avg_bet_exprs(p), payout_expr(), last_bet_expr("bets_count"))
        assert rows(gaming_state.gaming_metrics(state, p), *want.columns) == rows(want)
        want = so_far[0].groupBy("client_id").agg(last_bet_expr("bet_amount"))
        assert rows(gaming_state.gaming_metrics(state, p, "last_bet_day", False), *want.columns) == rows(want)
        want = ops.top_products(so_far[1], p, (LIFETIME, 7, 30, 90))
        assert rows(gaming_state.top_products(state, p), *want.columns) == rows(want)
        assert state.days.where(F.col("summary_day") < F.lit(gaming_state.window_start(p))).isEmpty()
        counted = {r["table"]: r["rows"] for r in gaming_state.stored_rows(state).collect()}
        assert counted["days"] + counted["lifetime"] == seen == counted["plays"] + counted["plays_lifetime"]


def test_report_a_from_state(spark, tmp_path):
    from customer360.catalog import PARAMS_A
    from customer360.sources.fixtures import Fixtures

    f = Fixtures(spark, "/root/testdata/sf0.001")
    late = (F.col("client_id") % 3 == 0) & (F.dayofmonth("summary_day") < 9)
    path = str(tmp_path / "s")
    refresh_gaming_state(f.game_days().where(~late), f.game_plays().where(~late), PARAMS_A, path)
    state = refresh_gaming_state(f.game_days().where(late), f.game_plays().where(late), PARAMS_A, path)
    a = (f.customers(), f.transactions(), f.game_days(), f.game_plays())
    got, want = ops.report_a(*a, PARAMS_A, state=state), ops.report_a(*a, PARAMS_A)
    assert got.columns == want.columns and rows(got) == rows(want)
    scans = got._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in scans  # neither game days nor plays are read


def test_state_of_game_days_without_returns(spark):
    p = ReportParams(asof=FIRST)
    days = spark.createDataFrame([(1, FIRST, D(4), 2, D(1), D(1), D(1))], DAYS).drop("returns_amount")
    state = gaming_state.advance(None, days, spark.createDataFrame([], PLAYS), p)
    r = gaming_state.gaming_metrics(state, p).first()
    assert (r["avg_bet_7_days"], r["ngr_lifetime"], r["payout_percent"]) == (2.0, 1.0, None)


def test_a_state_run_that_fails_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "s")
    p = ReportParams(asof=FIRST)
    days = spark.createDataFrame([(1, FIRST, D(1), 1, D(1), D(1), D(1))], DAYS)
    plays = spark.createDataFrame([(1, "P", "G", 1, FIRST)], PLAYS)
    refresh_gaming_state(days, plays, p, path)
    bad = plays.withColumn("played_count", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        refresh_gaming_state(days, bad, p, path)
    state = refresh_gaming_state(days, plays, p, path)
    assert {r["table"]: r["rows"] for r in gaming_state.stored_rows(state).collect()} == {"days": 2, "lifetime": 0, "plays": 2, "plays_lifetime": 0}


def test_latest_balances_over_ten_days(spark, tmp_path):
    rng = random.Random(2)
    kind, path, so_far = "client_id long, summary_day date, balance decimal(18,2)", str(tmp_path / "b"), []
    for k in range(10):
        asof = FIRST + dt.timedelta(days=k)
        today = []
        for _ in range(60):
            day = None if rng.random() < 0.05 else asof - dt.timedelta(days=rng.choice([0, 0, 0, 1, 2, 9]))
            today.append((None if rng.random() < 0.05 else rng.randrange(25), day, None if rng.random() < 0.1 else D(rng.randrange(900)) / 100))
        so_far += today
        got = refresh_latest_balances(spark.createDataFrame(today, kind).repartition(2), path)
        want = ops.latest_balance(spark.createDataFrame(so_far, kind))
        assert rows(ops.shown_balance(got)) == rows(want)
    refresh_latest_balances(spark.createDataFrame([], kind), path)
    assert rows(ops.shown_balance(Versions(spark, path).read())) == rows(want)


def test_daily_jobs_with_state(spark, tmp_path):
    """The command line: a first run over all tables, a second one over what arrived."""
    from customer360.jobs import TABLES_A, TABLES_B, Inputs, main

    sf = "/root/testdata/sf0.001"
    for report, names in (("a", TABLES_A), ("b", TABLES_B)):
        root, later, out = (str(tmp_path / f"{x}_{report}") for x in ("tables", "arrived", "out"))
        split = {"game_days": "summary_day", "game_plays": "summary_day", "balances": "summary_day"}
        for n, df in Inputs.from_fixtures(spark, sf, names).tables.items():
            late = F.col(split[n]) >= F.lit(dt.date(1997, 6, 1)) if n in split else F.lit(False)
            df.where(~late).write.parquet(f"{root}/{n}")
            if n in split:
                df.where(late).write.parquet(f"{later}/{n}")
        common = ["--report", report, "--asof", "2001-08-01", "--vip-min-amount", "1000000", "--crossing-amount", "300000", "--out", out]
        main([*common, "--tables", root, "--state", str(tmp_path / "state")])
        main([*common, "--tables", root, "--state", str(tmp_path / "state"), "--arrived", later])
        main([*common, "--fixtures", sf, "--name", "whole"])
        got = published(spark, f"report_{report}", out)
        want = published(spark, "whole", out)
        assert got.count() > 0 and rows(got) == rows(want)

"""Plan tests: push-down, pruning, no Python in the plans, broadcast of small
dimensions, one aggregation per source, no extra shuffle in the join chain."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from customer360.catalog import QUERIES
from customer360 import operators as ops
from customer360.config import ReportParams
from customer360.plans.inspect import plan_text


def plan(df, mode="formatted") -> str:
    return plan_text(df, mode)


@pytest.fixture(scope="module")
def raw_tx(spark, tmp_path_factory):
    """A transaction table stored with raw columns, as a real source would be."""
    from customer360.sources.fixtures import Fixtures

    path = str(tmp_path_factory.mktemp("tx") / "tx.parquet")
    Fixtures(spark, SF001).transactions().write.parquet(path)
    return spark.read.parquet(path)


def test_filters_and_columns_reach_the_scan(raw_tx):
    p = ReportParams(asof=dt.date(2001, 8, 1))
    txt = plan(ops.deposit_horizons(raw_tx, p))
    scan = txt[txt.index("Scan parquet"):]
    pushed = re.search(r"PushedFilters: \[(.*)\]", scan).group(1)
    assert "In(status" in pushed and "EqualTo(txn_type,2)" in pushed
    schema = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert "user_name" not in schema and "currency_fk" not in schema


def test_flows_one_scan_one_shuffle(raw_tx):
    p = ReportParams(asof=dt.date(2001, 8, 1))
    txt = plan(ops.flow_horizons(raw_tx, p))
    tree = txt.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1
    assert len(re.findall(r"Exchange \(\d+\)", tree)) == 1
    assert "partial_sum" in txt  # map-side partial aggregation before the shuffle


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_in_plans(spark, key):
    txt = plan(QUERIES[key](spark, SF001), "simple")
    assert "PythonUDF" not in txt and "EvalPython" not in txt and "ArrowEvalPython" not in txt


def test_small_dimensions_are_broadcast(spark):
    txt = plan(QUERIES["customer_dimension"](spark, SF001))
    assert txt.count("BroadcastHashJoin") >= 3


def test_top_products_one_aggregation_no_window(spark):
    from customer360.catalog import PARAMS_A
    from customer360.sources.fixtures import Fixtures

    f = Fixtures(spark, SF001)
    lazy = ops.report_a(f.customers(), f.transactions(), f.game_days(), f.game_plays(), PARAMS_A)
    txt = plan(lazy, "simple")
    # The four top-product horizons share one (customer, product) aggregation
    # and one per-customer min(struct) aggregation; no per-horizon window.
    assert "min(CASE WHEN isnotnull(in_lft" in txt and "min(CASE WHEN isnotnull(in_90d" in txt
    assert "row_number" not in txt


def test_building_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for key, query in QUERIES.items():
        query(spark, SF001)  # file listings and footers only
        spark.sparkContext.setJobGroup(key, key)
        query(spark, SF001)
        assert not tracker.getJobIdsForGroup(key), key
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_stored_cohort_spares_the_transactions(spark):
    from customer360.catalog import PARAMS_A, PARAMS_B
    from customer360.plans import cut_lineage
    from customer360.sources.fixtures import Fixtures

    f = Fixtures(spark, SF001)
    a = (f.customers(), f.transactions(), f.game_days(), f.game_plays())
    flows = cut_lineage(ops.cohort_flows(f.transactions(), PARAMS_A))
    stored = ops.report_a(*a, PARAMS_A, flows=flows)
    assert "Window [" not in plan(stored, "simple") and rows(stored) == rows(ops.report_a(*a, PARAMS_A))
    b = (f.attributes(), f.customers(), f.merchants(), f.countries(), f.languages(), f.transactions(),
         f.currencies(), f.game_days(), f.balances(), f.bonuses())
    flows = cut_lineage(ops.cohort_ledger(f.transactions(), f.currencies(), PARAMS_B))
    stored = ops.report_b(*b, PARAMS_B, flows=flows)
    tree = plan(stored).split("\n\n")[0]
    assert tree.count("LeftSemi") >= 4  # the raw inputs are cut to the stored cohort
    assert rows(stored) == rows(ops.report_b(*b, PARAMS_B))


@pytest.mark.parametrize("unique", [False, True])
def test_running_counts_need_two_shuffles_of_totals(raw_tx, unique):
    """The main path: per (customer, day), then per customer. By default two more
    shuffles carry the zone map of ids and its days."""
    from customer360.plans import plan_summary

    p = ReportParams(asof=dt.date(2001, 8, 1), unique_txn_ids=unique)
    for df in (ops.flow_summary(raw_tx, p), ops.qualification_date(raw_tx, p), ops.cumulative_flow(raw_tx, p)):
        s = plan_summary(df)
        assert (s["hash_shuffles"], s["smj"]) == (2 if unique else 4, 0)
        txt = plan(df)
        keys = [k for k in re.findall(r"hashpartitioning\((.*?), \d+\)", txt)]
        # No shuffle is dealt by the raw id: ids travel as zones, or as NULL where no id repeats.
        assert not any(re.search(r"\bid#", k) for k in keys), keys
    zones = plan(ops.id_zones(raw_tx))
    assert "partial_bit_or" in zones and "SortAggregate" not in zones


def test_latest_balance_one_scan_one_shuffle_no_join(spark, tmp_path):
    from customer360.plans import plan_summary
    from customer360.sources.fixtures import Fixtures

    path = str(tmp_path / "balances.parquet")
    Fixtures(spark, SF001).balances().write.parquet(path)
    df = ops.latest_balance(spark.read.parquet(path))
    s = plan_summary(df)
    assert (s["scans"], s["hash_shuffles"], s["smj"], s["broadcasts"]) == (1, 1, 0, 0)
    assert "WindowGroupLimit" in plan(df, "simple")


def test_join_chain_reuses_customer_partitioning(spark):
    """With broadcasts disabled, the left-join chain of per-customer frames adds
    no exchange: each frame is already hash-partitioned on client_id."""
    from customer360.sources.fixtures import Fixtures

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = Fixtures(spark, SF001)
        p = ReportParams(asof=dt.date(2001, 8, 1))
        a = ops.flow_horizons(f.transactions(), p)
        b = ops.revenue_horizons(f.game_days(), p)
        c = ops.last_active_day(f.game_days())
        tree = plan(a.join(b, "client_id", "left").join(c, "client_id", "left")).split("\n\n")[0]
        exchanges = len(re.findall(r"Exchange \(\d+\)", tree))
        aggregations = 3
        adapter_joins = tree.count("SortMergeJoin Inner")  # lineitem x orders inside the adapters
        assert tree.count("SortMergeJoin LeftOuter") == 2
        assert exchanges == aggregations + 2 * adapter_joins
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(scope="module")
def stored_b(spark, tmp_path_factory):
    """Job B's logical tables as stored tables, as a real source has them."""
    from customer360.jobs import TABLES_B, Inputs

    root = tmp_path_factory.mktemp("logical")
    for name, df in Inputs.from_fixtures(spark, SF001, TABLES_B).tables.items():
        df.write.parquet(str(root / f"{name}.parquet"))
    return Inputs.from_dir(spark, str(root), TABLES_B)


def executed(df) -> str:
    """The final adaptive plan, after a run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_report_b_reads_the_transactions_once(stored_b):
    from customer360.catalog import PARAMS_B

    i = stored_b
    txt = executed(ops.report_b(i.attributes, i.customers, i.merchants, i.countries, i.languages, i.transactions, i.currencies,
                                i.game_days, i.balances, i.bonuses, PARAMS_B))
    scans = re.findall(r"FileScan parquet .*?/(\w+)\.parquet", txt)
    assert [scans.count(t) for t in ("transactions", "game_days", "balances", "bonuses")] == [1, 1, 1, 1], scans
    assert len(re.findall(r"(?:\+|:)- Window \[|^ *Window \[|\bWindow \[", txt)) <= 2
    assert txt.count("Exchange hashpartitioning") <= 10
    assert "CartesianProduct" not in txt


def test_ledger_is_one_scan_and_two_shuffles_of_facts(stored_b):
    from customer360.catalog import PARAMS_B
    from customer360.plans import plan_summary

    s = plan_summary(ops.ledger(stored_b.transactions, stored_b.currencies, PARAMS_B))
    # The third shuffle is that of the rate rows.
    assert (s["scans"], s["hash_shuffles"], s["windows"], s["smj"]) == (2, 3, 1, 0)


def test_null_join_of_a_million_partitions_is_built_at_once(spark):
    import time

    left = spark.createDataFrame([(1, "a"), (2, None)], "k long, email string")
    right = spark.createDataFrame([("a", 10), (None, 20)], "req string, turn long")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1000000")
    try:
        start = time.time()
        txt = plan(ops.contact_enrichment(left, right.withColumnRenamed("req", "requester_email")))
        assert time.time() - start < 5 and len(txt) < 50_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_horizon_filter_reaches_the_scan(spark, tmp_path):
    from customer360.sources.fixtures import Fixtures

    path = str(tmp_path / "plays.parquet")
    Fixtures(spark, SF001).game_plays().write.parquet(path)
    plays = spark.read.parquet(path)
    p = ReportParams(asof=dt.date(2001, 8, 1))
    txt = plan(ops.top_product(plays, p, 7))
    pushed = re.search(r"PushedFilters: \[(.*)\]", txt[txt.index("Scan parquet"):]).group(1)
    assert "GreaterThanOrEqual(summary_day,2001-07-25)" in pushed


def test_plan_summary_helper(raw_tx):
    from customer360.plans import plan_summary, pushed_filters

    p = ReportParams(asof=dt.date(2001, 8, 1))
    df = ops.flow_horizons(raw_tx, p)
    assert plan_summary(df) == {"scans": 1, "hash_shuffles": 1, "spread_shuffles": 0, "broadcasts": 0,
                                "smj": 0, "windows": 0, "sort_aggs": 0}
    assert any("In(status" in f for f in pushed_filters(df))

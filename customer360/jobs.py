"""The two daily report jobs, end to end.

Job A: VIP customer report -> money columns as EUR text, averages rounded ->
dated dataset. Job B: VIP summary -> metrics rounded -> last help-desk contact
attached by e-mail -> dated dataset.

Inputs are the logical tables as DataFrames (``Inputs``). ``Inputs.from_dir``
reads a directory with one dataset per logical table (parquet by default);
``Inputs.from_fixtures`` derives them from the test tables. Any table can
also come from a database (``Inputs.from_jdbc``).

    python -m customer360.jobs --report a --tables /data/tables --out /data/reports --asof 2001-08-01
    python -m customer360.jobs --report b --fixtures /root/testdata/sf0.01 --out /tmp/out
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from customer360 import operators as ops
from customer360.config import ReportParams
from customer360.operators.flows import DEPOSIT, WITHDRAWAL
from customer360.plans.lineage import cut_lineage
from customer360.plans.settings import shuffle_partitions_for, tune_session
from customer360.operators import gaming_state
from customer360.operators.customers import merge_latest
from customer360.operators.gaming_state import GamingState
from customer360.sources.sinks import publish
from customer360.sources.source_schemas import check_columns
from customer360.sources.tables import path_exists, read_jdbc
from customer360.sources.versions import Versions

# Logical tables of the two jobs.
TABLES_A = ("customers", "transactions", "game_days", "game_plays")
TABLES_B = ("attributes", "customers", "merchants", "countries", "languages", "transactions", "currencies",
            "game_days", "balances", "bonuses", "last_contacts")
# Dataset names of the two reports, unless the caller gives others.
DATASETS = {"a": "report_a", "b": "report_b"}
ROLLUP_TASKS_PER_DAY = 8
# Tables whose arrivals a stored state takes in.
STATE_TABLES = {"a": ("game_days", "game_plays"), "b": ("game_days", "balances")}


@dataclass
class Inputs:
    tables: dict[str, DataFrame]

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.tables[name]
        except KeyError as e:
            raise AttributeError(name) from e

    @classmethod
    def from_dir(cls, spark: SparkSession, root: str, names, fmt: str = "parquet") -> "Inputs":
        from customer360.sources.tables import TableSet

        ts = TableSet(spark, root, fmt)
        return cls({n: ts[n] for n in names})

    @classmethod
    def from_source(cls, tables, job: str) -> "Inputs":
        """Tables with the source jobs' column names (keyed by logical name)."""
        from customer360.sources.source_schemas import to_logical

        return cls(to_logical(tables, job))

    @classmethod
    def from_jdbc(cls, spark: SparkSession, options: Mapping[str, Mapping], job: str) -> "Inputs":
        """Tables of a source database, read by :func:`read_jdbc`: ``options`` maps
        each logical name to its arguments (url, table, partition column and
        bounds, connection options). Columns are the source jobs' own."""
        return cls.from_source({n: read_jdbc(spark, **dict(o)) for n, o in options.items()}, job)

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str, names) -> "Inputs":
        from customer360.sources.fixtures import Fixtures

        f = Fixtures.shared(spark, sf_dir)
        return cls({n: getattr(f, n)() for n in names})


def refresh_flow_rollup(tx: DataFrame, p: ReportParams, path: str, days_back: int | None = None) -> DataFrame:
    """Rebuild the per-(customer, day) flow rollup for recent days and return the whole rollup.

    With ``days_back`` only transactions from that many days before ``asof``
    on are read (a pushed-down date filter) and every stored day from there on
    is replaced, also one that has no rows left. ``days_back=None`` replaces
    the whole rollup; so does a first run, when nothing is stored at ``path``
    yet. Undated rows belong to every rebuild. Choose ``days_back`` to cover the
    period in which transactions can still change status, and use the same
    ``ReportParams`` codes when reading. Days are written by a bounded number of
    tasks each (``ROLLUP_TASKS_PER_DAY``), so that files do not multiply.
    """
    spark = tx.sparkSession
    kind = T.StructField("txn_date", T.DateType())
    if days_back is None or not path_exists(spark, path):
        daily, mode = ops.flow_daily(tx, p), "static"
    else:
        start = p.asof - dt.timedelta(days=days_back)
        recent = (F.col("txn_date") >= F.lit(start)) | F.col("txn_date").isNull()
        daily, mode = ops.flow_daily(tx.filter(recent), p), "dynamic"
        # Dynamic overwrite leaves days without new rows as they are: give those
        # that had rows a placeholder that readers drop.
        stored = spark.read.parquet(path).select(F.col("txn_date").cast("date").alias("txn_date")).filter(recent).distinct()
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in daily.schema if f.name != "txn_date"]
        daily = daily.unionByName(stored.select("txn_date", *nothing))
    spread = F.pmod(F.xxhash64("client_id"), F.lit(ROLLUP_TASKS_PER_DAY))
    out = daily.repartition("txn_date", spread)
    out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("txn_date").parquet(path)
    schema = T.StructType([f for f in daily.schema if f.name != "txn_date"] + [kind])
    return spark.read.schema(schema).parquet(path).where(f"_{DEPOSIT}_any is not null or _{WITHDRAWAL}_any is not null")


def refresh_gaming_state(game_days: DataFrame, plays: DataFrame, p: ReportParams, path: str) -> GamingState:
    """Add the rows that arrived since the last run to the gaming state stored under
    ``path`` and return it. The first run takes the whole history as arrivals.

    Each run reads the stored tables and the arrivals and publishes new tables
    together (:class:`Versions`: one marker makes all four current), so a run that
    fails leaves the state as it was and can be repeated with the same arrivals."""
    spark = game_days.sparkSession
    store = Versions(spark, path, "parquet")
    at = store.current()
    old = None if at is None else gaming_state.from_tables({t: spark.read.parquet(f"{at}/{t}") for t in gaming_state.TABLES})
    new = gaming_state.advance(old, game_days, plays, p)
    at = store.write_tables(new.tables())
    return gaming_state.from_tables({t: spark.read.parquet(f"{at}/{t}") for t in gaming_state.TABLES})


def refresh_latest_balances(balances: DataFrame, path: str) -> DataFrame:
    """Merge the balance snapshots that arrived since the last run into the latest
    rows stored under ``path`` and return them."""
    store = Versions(balances.sparkSession, path)
    store.write(merge_latest(store.read(), balances))
    return store.read()


def require_unique_ids(tx: DataFrame, p: ReportParams, days_back: int | None = None) -> None:
    """Raise if an id repeats within a day. A run that passes may use
    ``unique_txn_ids``. The check is a zone map (:func:`customer360.operators.id_zones`),
    whose shuffle carries zones of 64 ids; with ``days_back`` it covers only
    the days that a rollup of so many days rebuilds."""
    if days_back is not None:
        tx = tx.filter((F.col("txn_date") >= F.lit(p.asof - dt.timedelta(days=days_back))) | F.col("txn_date").isNull())
    twice = ops.repeated_id_days(ops.filter_approved(tx, p, p.deposit_type)).limit(1)
    if not twice.isEmpty():
        raise ValueError(f"transaction ids repeat, for example on {twice.first()['txn_date']}")


def job_a(inputs: Inputs, p: ReportParams, flow_rollup: DataFrame | None = None, store: bool = False,
          state: GamingState | None = None) -> DataFrame:
    """Report A, presented: EUR money text and rounded average bets. With
    ``store`` the cohort's metrics (one row per VIP customer) are computed once
    and checkpointed in the session's shared folder before the report."""
    check_columns(inputs.tables, p)
    flows = ops.cohort_flows(inputs.transactions, p, flow_rollup)
    rep = ops.report_a(inputs.customers, inputs.transactions, inputs.game_days, inputs.game_plays, p,
                       flows=cut_lineage(flows) if store else flows, state=state)
    return ops.format_money(rep, p)


def job_b(inputs: Inputs, p: ReportParams, store: bool = False, state: GamingState | None = None,
          latest: DataFrame | None = None) -> DataFrame:
    """Report B, presented: rounded metrics with the last help-desk contact. With
    ``store`` the cohort's flows and then the report (one row per VIP customer and
    attribute) are computed once and checkpointed."""
    check_columns(inputs.tables, p)
    flows = cut_lineage(ops.cohort_ledger(inputs.transactions, inputs.currencies, p)) if store else None
    rep = ops.report_b(
        inputs.attributes, inputs.customers, inputs.merchants, inputs.countries, inputs.languages,
        inputs.transactions, inputs.currencies, inputs.game_days, inputs.balances, inputs.bonuses, p, flows=flows,
        state=state, latest=latest,
    )
    rep = ops.round_metrics(rep, p)
    # A stored report is counted where it lies; otherwise its NULL e-mails are those of the customers.
    return ops.contact_enrichment(cut_lineage(rep) if store else rep, inputs.last_contacts, sized_by=None if store else inputs.customers)


def run(spark: SparkSession, report: str, inputs: Inputs, p: ReportParams, out_root: str, fmt: str = "parquet",
        name: str | None = None, **kept) -> str:
    """Compute and publish one report as dataset ``name``; returns its path. ``kept``
    are the stored tables that :func:`job_a` and :func:`job_b` take."""
    if report not in DATASETS:
        raise ValueError(f"unknown report {report!r}")
    df = (job_a if report == "a" else job_b)(inputs, p, store=True, **kept)
    return publish(df, p.asof, name or DATASETS[report], out_root, fmt)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--report", choices=["a", "b"], required=True)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="directory with one dataset per logical table")
    src.add_argument("--source-tables", help="same, but with the source jobs' column names and codes")
    src.add_argument("--jdbc", help="JSON file: logical table -> arguments of read_jdbc (keep it out of the repository)")
    src.add_argument("--fixtures", help="test-data directory (driver tables)")
    ap.add_argument("--out", required=True, help="output root (shared storage on a cluster)")
    ap.add_argument("--name", default=None, help="dataset name (default: report_a / report_b)")
    ap.add_argument("--asof", default=None, help="report date, YYYY-MM-DD (default: today)")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--vip-min-amount", type=float, default=None)
    ap.add_argument("--vip-min-count", type=int, default=None)
    ap.add_argument("--crossing-amount", type=float, default=None)
    ap.add_argument("--input-bytes", type=int, default=None,
                    help="size of the largest input table; sizes spark.sql.shuffle.partitions")
    ap.add_argument("--flow-rollup", default=None,
                    help="report a: day-partitioned transaction rollup to keep up to date and read")
    ap.add_argument("--unique-ids", action="store_true",
                    help="report a: check that transaction ids do not repeat within a day and use it")
    ap.add_argument("--rollup-days", type=int, default=None,
                    help="days to rebuild in the rollup (default: all)")
    ap.add_argument("--state", default=None,
                    help="folder of the gaming state (and, report b, latest balances) to carry forward and read")
    ap.add_argument("--arrived", default=None,
                    help="with --state: directory with the rows that arrived since the last run (default: all tables, a first run)")
    a = ap.parse_args(argv)

    kw = {}
    if a.asof:
        kw["asof"] = dt.date.fromisoformat(a.asof)
    for k in ("vip_min_amount", "vip_min_count", "crossing_amount"):
        if getattr(a, k) is not None:
            kw[k] = getattr(a, k)
    if a.source_tables or a.jdbc:
        from customer360.sources.source_schemas import job_a_params, job_b_params

        p = (job_a_params if a.report == "a" else job_b_params)(**kw)
    else:
        p = ReportParams(**kw)
    spark = SparkSession.builder.appName(f"customer360-report-{a.report}").getOrCreate()
    local = spark.sparkContext.master.startswith("local")
    tune_session(spark, shuffle_partitions_for(a.input_bytes) if a.input_bytes else None,
                 parallelism_first=None if local else False)
    names = TABLES_A if a.report == "a" else TABLES_B
    if a.tables:
        inputs = Inputs.from_dir(spark, a.tables, names)
    elif a.source_tables:
        inputs = Inputs.from_source(Inputs.from_dir(spark, a.source_tables, names).tables, a.report)
    elif a.jdbc:
        text = spark.read.text(a.jdbc, wholetext=True).first()["value"]
        inputs = Inputs.from_jdbc(spark, json.loads(text), a.report)
    else:
        inputs = Inputs.from_fixtures(spark, a.fixtures, names)
    if a.report == "a" and a.unique_ids:
        rebuilt = a.rollup_days if a.flow_rollup and path_exists(spark, a.flow_rollup) else None
        require_unique_ids(inputs.transactions, p, rebuilt)
        p = replace(p, unique_txn_ids=True)
    kept = {}
    if a.report == "a" and a.flow_rollup:
        kept["flow_rollup"] = refresh_flow_rollup(inputs.transactions, p, a.flow_rollup, a.rollup_days)
    if a.state:
        arrived = Inputs.from_dir(spark, a.arrived, [n for n in STATE_TABLES[a.report]]) if a.arrived else inputs
        if a.arrived and a.source_tables:
            arrived = Inputs.from_source(arrived.tables, a.report)
        # Job B has no plays: its state holds none.
        plays = arrived.game_plays if a.report == "a" else arrived.game_days.select(
            "client_id", *[F.lit(None).cast("string").alias(c) for c in ("provider_name", "product_name")],
            F.lit(None).cast("bigint").alias("played_count"), "summary_day").where("false")
        kept["state"] = refresh_gaming_state(arrived.game_days, plays, p, f"{a.state}/gaming_{a.report}")
        if a.report == "b":
            kept["latest"] = refresh_latest_balances(arrived.balances, f"{a.state}/balances")
    print(run(spark, a.report, inputs, p, a.out, a.format, a.name, **kept))


if __name__ == "__main__":
    main()

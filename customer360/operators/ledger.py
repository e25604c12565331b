"""Report B's transactions in one pass.

The source reads the transactions once per metric: horizons in base currency
against every rate row, and the crossing date against the distinct valid rates.
Here each transaction meets its currency's rate rows once
(:func:`customer360.operators.fx.rate_rows`: every row counts for the flows, the
marked ones for the crossing), is converted once, and everything else follows
from totals per customer and day: two pre-aggregated shuffles and one window
over at most one row per customer and calendar day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from customer360.config import ReportParams
from customer360.functions.expressions import to_day
from customer360.functions.money import Money
from customer360.operators.flows import DEPOSIT, WITHDRAWAL, day_total_exprs, filter_approved
from customer360.operators.fx import in_base, rate_rows
from customer360.operators.milestones import first_day, up_to_day


def ledger_days(tx: DataFrame, rates: DataFrame, p: ReportParams) -> tuple[DataFrame, int]:
    """Per customer and day: totals of both kinds in base currency (all rate rows),
    and of deposits at the distinct valid rates (``_crossing``); and the scale of
    the money. One scan of ``tx``; a customer's day is collapsed map-side."""
    kinds = {DEPOSIT: p.deposit_type, WITHDRAWAL: p.withdrawal_type}
    t = filter_approved(tx, p).filter(F.col("txn_type").isin(*kinds.values()))
    t = t.select("id", "client_id", "txn_date", "txn_type", "currency_fk", "amount")
    r = rate_rows(rates).withColumnRenamed("id", "_rate_id")
    j = t.join(r, F.col("currency_fk") == F.col("_rate_id"), "left")
    eur = in_base(tx, "amount", rates, p)
    j = j.select("client_id", to_day("txn_date").alias("txn_date"), "txn_type", "counted", F.col("id").isNotNull().cast("bigint").alias("_one"),
                 *[c.alias(n) for n, c in eur.named("_eur").items()])
    eur = Money.column("_eur", j.columns, eur.scale)
    aggs = []
    for prefix, kind in kinds.items():
        is_kind = F.col("txn_type") == F.lit(kind)
        aggs += [
            F.max(F.when(is_kind, F.lit(1))).alias(f"_{prefix}_any"),
            F.sum(F.when(is_kind, F.col("_one"))).alias(f"_{prefix}_cnt"),
            *[c.alias(n) for n, c in eur.only(is_kind).total().named(f"_{prefix}").items()],
        ]
    counted = (F.col("txn_type") == F.lit(p.deposit_type)) & F.col("counted")
    aggs += [c.alias(n) for n, c in eur.only(counted).total().named("_crossing").items()]
    return j.groupBy("client_id", "txn_date").agg(*aggs), eur.scale


def ledger(tx: DataFrame, rates: DataFrame, p: ReportParams) -> DataFrame:
    """Per customer: deposits and withdrawals in base currency (horizons, lifetime,
    count, day span), net deposits, whether the running deposits at valid rates
    reached ``crossing_amount`` (``reached``), and the day (``date_of_reaching_1k``).

    Equals ``flow_horizons`` of ``fx_normalise`` left-joined with ``threshold_crossing``."""
    days, scale = ledger_days(tx, rates, p)
    amounts = {k: Money.column(f"_{k}", days.columns, scale) for k in (DEPOSIT, WITHDRAWAL)}
    run = days.withColumns(Money.column("_crossing", days.columns, scale).total(up_to_day()).named("_run"))
    reached = Money.column("_run", run.columns, scale).at_least(p.crossing_amount)
    net = amounts[DEPOSIT].total().minus(amounts[WITHDRAWAL].total()).double()
    out = run.groupBy("client_id").agg(*day_total_exprs(p, amounts), net.alias("net_deposits"), first_day(reached).alias("_first"))
    out = out.withColumns({"reached": F.col("_first").isNotNull(), "date_of_reaching_1k": F.col("_first.txn_date")})
    return out.drop("_first")


def cohort_ledger(tx: DataFrame, rates: DataFrame, p: ReportParams) -> DataFrame:
    """:func:`ledger` of job B's VIP customers."""
    return ledger(tx, rates, p).filter("reached").drop("reached")

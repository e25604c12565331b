"""Threshold crossing: the first day running base-currency deposits reach a level."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from customer360.config import ReportParams
from customer360.functions.expressions import to_day
from customer360.functions.money import Money, stored_eur
from customer360.operators.fx import fx_normalise_valid


def up_to_day() -> WindowSpec:
    """The days of a customer up to the current one; a NULL day comes first, as job B's database sorts it."""
    w = Window.partitionBy("client_id").orderBy(F.col("txn_date").asc_nulls_first())
    return w.rangeBetween(Window.unboundedPreceding, Window.currentRow)


def first_day(qualifies) -> F.Column:
    """Aggregate: (has a date, date) of the first qualifying day, a NULL day first."""
    return F.min(F.when(qualifies, F.struct(F.col("txn_date").isNotNull(), "txn_date")))


def _running(tx: DataFrame, rates: DataFrame, p: ReportParams) -> tuple[DataFrame, Money, Money]:
    """Per customer and day: base-currency deposits and their exact running total.

    Amounts use the distinct valid rates. The window runs over one row per
    (customer, day), so a partition never holds more rows than there are
    calendar days, however many transactions a customer has.
    """
    valid = fx_normalise_valid(tx, rates, p, p.deposit_type)
    eur = stored_eur(valid, p.fx_extra_digits)
    daily = valid.groupBy("client_id", to_day("txn_date").alias("txn_date")).agg(
        *[c.alias(n) for n, c in eur.total().named("_dep").items()])
    dep = Money.column("_dep", daily.columns, eur.scale)
    run = daily.withColumns(dep.total(up_to_day()).named("_run"))
    return run, dep, Money.column("_run", run.columns, eur.scale)


def cumulative_deposits_eur(tx: DataFrame, rates: DataFrame, p: ReportParams) -> DataFrame:
    """Per customer and day: base-currency deposits and their running total."""
    run, dep, total = _running(tx, rates, p)
    return run.select("client_id", "txn_date", dep.double().alias("deposits"), total.double().alias("total_dpst"))


def threshold_crossing(tx: DataFrame, rates: DataFrame, p: ReportParams, min_amount=None) -> DataFrame:
    """``client_id, date_of_reaching_1k``: first day with running total >= ``min_amount``.

    The first qualifying day by ascending date (``row_number() = 1``) is the
    minimum qualifying day, computed as a partially aggregated ``min``; the
    source's database sorts a NULL day first, so one that qualifies is it.
    """
    min_amount = p.crossing_amount if min_amount is None else min_amount
    run, _, total = _running(tx, rates, p)
    return (
        run.filter(total.at_least(min_amount))
        .groupBy("client_id")
        .agg(first_day(F.lit(True)).alias("first"))
        .select("client_id", F.col("first.txn_date").alias("date_of_reaching_1k"))
    )

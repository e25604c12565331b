"""Currency normalisation.

``rates``: ``id, rate_to_eur, is_valid``; an id may have several rows.
Rates are a dimension bounded by the number of currencies; the join is a
plain equi-join and Spark broadcasts the rate side when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` (checked statically from the
scan statistics and again at runtime by AQE), otherwise it shuffles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from customer360.config import ReportParams
from customer360.functions.money import Money, divided
from customer360.operators.flows import filter_approved

# The per-code conversion rates of the game summaries (codes
# not listed convert at 1).
CASE_RATES = {
    "CAD": Decimal("0.67"),
    "USDT": Decimal("0.92"),
    "BRL": Decimal("0.17"),
    "EUR": Decimal("1"),
    "NZD": Decimal("0.60"),
    "USD": Decimal("0.91"),
    "AUD": Decimal("0.61"),
    "GBP": Decimal("1.18"),
}
DEFAULT_CASE_RATE = Decimal("1")


def in_base(amounts: DataFrame, column: str, rates: DataFrame, p: ReportParams, rate: str = "rate_to_eur") -> Money:
    """``column`` of ``amounts`` over a joined rate (column ``rate``) of ``rates``: exact at
    the declared scale and ``fx_extra_digits`` more, NULL where the rate is 0/NULL."""
    kind, rate_kind = amounts.schema[column].dataType, rates.schema["rate_to_eur"].dataType
    return divided(F.col(column), kind, F.col(rate), rate_kind, p.fx_extra_digits)


def fx_normalise(tx: DataFrame, rates: DataFrame, p: ReportParams) -> DataFrame:
    """Approved transactions with ``rate_to_eur`` and ``amount_eur``, all rate rows.

    Every rate row of the currency joins, so a currency with two rows doubles
    its transactions (the source behaviour, kept on purpose); a currency
    without a rate gives a NULL amount that sums ignore. Amounts of very wide
    types come as two columns (``functions.money``): ``amount_eur``, the whole part, and ``amount_eur_part``.
    """
    r = rates.select(F.col("id").alias("_rate_id"), "rate_to_eur")
    t = filter_approved(tx, p)
    return (
        t.join(r, t.currency_fk == r._rate_id, "left")
        .drop("_rate_id")
        .withColumns(in_base(tx, "amount", rates, p).named("amount_eur"))
    )


def valid_rates(rates: DataFrame) -> DataFrame:
    """Distinct (id, rate) pairs of valid rate rows."""
    return rates.filter(F.col("is_valid") == 1).select("id", "rate_to_eur").distinct()


def rate_rows(rates: DataFrame) -> DataFrame:
    """Every rate row (``id, rate_to_eur``), with ``counted`` true on exactly one
    row of each distinct valid pair: one join serves both rate sets."""
    pairs = rates.groupBy("id", "rate_to_eur").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.col("is_valid") == 1), F.lit(False)).alias("valid"))
    copies = pairs.select("id", "rate_to_eur", "valid", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("i"))
    return copies.select("id", "rate_to_eur", (F.col("valid") & (F.col("i") == 1)).alias("counted"))


def fx_normalise_valid(tx: DataFrame, rates: DataFrame, p: ReportParams, txn_type=None) -> DataFrame:
    """Approved transactions (optionally of one type) against distinct valid rates only."""
    r = valid_rates(rates).withColumnRenamed("id", "_rate_id")
    t = filter_approved(tx, p, txn_type)
    return (
        t.join(r, t.currency_fk == r._rate_id, "left")
        .drop("_rate_id")
        .withColumns(in_base(tx, "amount", rates, p).named("amount_eur"))
    )


def case_rate(code: Column) -> Column:
    """Currency code -> fixed conversion rate (DOUBLE), unlisted codes 1."""
    expr = None
    for k, v in CASE_RATES.items():
        cond, val = code == F.lit(k), F.lit(v)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(F.lit(DEFAULT_CASE_RATE)).cast("double")


def currency_case_rate(days: DataFrame, code_col: str = "currency_id") -> DataFrame:
    """Game-day rows with their ``conversion`` rate."""
    return days.withColumn("conversion", case_rate(F.col(code_col)))

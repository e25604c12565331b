"""Bonus cost: won bonuses in base currency, and per-customer expense and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from customer360.config import ReportParams
from customer360.functions.expressions import to_day
from customer360.functions.money import Money
from customer360.operators.fx import in_base
from customer360.plans.joins import fresh_names

WIN = "WIN"
#: Ending of a looked-up column whose name the bonuses already have.
LOOKUP_SUFFIX = "_lookup"


def _won(bonuses: DataFrame) -> DataFrame:
    return bonuses.filter(F.col("status") == WIN)


def bonus_enriched(
    bonuses: DataFrame,
    customers: DataFrame,
    rates: DataFrame,
    bonus_defs: DataFrame,
    merchants: DataFrame,
    attributes: DataFrame,
    countries: DataFrame,
    crossing: DataFrame,
    p: ReportParams,
) -> DataFrame:
    """Won bonuses (every column of ``bonuses`` passes through) with base-currency
    amount, promo, brand, affiliate, country and the customer's
    threshold-crossing date. A looked-up column whose name the bonuses have
    themselves ends in ``_lookup``.

    The per-customer lookups are joined to the distinct winners first, so that
    the raw bonus rows meet one join on the customer (which AQE can split if
    one customer holds many bonuses); promo and brand are small dimensions.
    Several rate or attribute rows of a customer repeat its bonuses, as the
    source's joins do.
    """
    won = _won(bonuses)
    # Looked-up columns under names that the bonuses lack, until the last step.
    looked_up = ["currency_fk", "rate_to_eur", "promo_code", "description", "merchant_name", "referral_info", "country_name", "date_of_reaching_1k"]
    own = dict(zip([*looked_up, "pid", "bid", "mid"], fresh_names([f"_{c}" for c in (*looked_up, "pid", "bid", "mid")], bonuses), strict=True))

    def named(df: DataFrame, **columns: str) -> DataFrame:
        return df.select([F.col(source).alias(own[name]) for name, source in columns.items()])

    r = rates.select(F.col("id").alias("_rid"), F.col("rate_to_eur").alias(own["rate_to_eur"]))
    g = countries.select(F.col("id").alias("_gid"), F.col("country_desc").alias(own["country_name"]))
    c = customers.select(F.col("id").alias(own["pid"]), F.col("currency_fk").alias(own["currency_fk"]), F.col("country_fk").alias("_country"))
    a = named(attributes, pid="client_id", referral_info="referral_info")
    h = named(crossing, pid="client_id", date_of_reaching_1k="date_of_reaching_1k")
    winners = named(won, pid="client_id").where(F.col(own["pid"]).isNotNull()).distinct()
    profile = (
        winners.join(c, own["pid"], "left").join(a, own["pid"], "left").join(h, own["pid"], "left")
        .join(r, F.col(own["currency_fk"]) == r._rid, "left")
        .join(g, F.col("_country") == g._gid, "left")
        .drop("_rid", "_gid", "_country")
    )
    d = named(bonus_defs, bid="id", promo_code="promo_code", description="description")
    m = named(merchants, mid="id", merchant_name="name")
    j = (
        won.join(profile, won.client_id == profile[own["pid"]], "left")
        .join(d, won.bonus_fk == d[own["bid"]], "left")
        .join(m, won.merchant_fk == m[own["mid"]], "left")
    )
    euro = in_base(bonuses, "winning_amount", rates, p, rate=own["rate_to_eur"]).double()
    taken = {x.lower() for x in bonuses.columns}
    added = []
    for name in ["currency_fk", "rate_to_eur", "win_amount_euro", "promo_code", "description", "merchant_name", "referral_info",
                 "country_name", "date_of_reaching_1k"]:
        value = euro if name == "win_amount_euro" else F.col(own[name]).cast("double") if name == "rate_to_eur" else F.col(own[name])
        added.append(value.alias(name + LOOKUP_SUFFIX if name in taken else name))
    passed = [F.col(f"`{x}`").cast("double").alias(x) if x == "winning_amount" else F.col(f"`{x}`") for x in bonuses.columns if x != "bonus_date"]
    return j.select(*passed, *added, to_day("bonus_date").alias("bonus_date"))


def won_bonuses(bonuses: DataFrame) -> DataFrame:
    """Won bonuses counted (``n``) per customer, day and amount.

    Rows that agree on these give the same base amount and the same conditions,
    so a customer with very many bonuses is collapsed map-side before any
    shuffle or join."""
    return _won(bonuses).groupBy(
        "client_id", to_day("bonus_date").alias("bonus_date"), "winning_amount"
    ).agg(F.count(F.lit(1)).alias("n"))


def _scale(bonuses: DataFrame, p: ReportParams) -> int:
    kind = bonuses.schema["winning_amount"].dataType
    return kind.scale + p.fx_extra_digits if isinstance(kind, DecimalType) else 0


def expense_exprs(bonuses: DataFrame, rates: DataFrame, p: ReportParams) -> list[Column]:
    """Aggregates over won bonuses (``n`` rows each) with rate and crossing date:
    the exact expense (``_spent``), the positive bonuses, and the positive ones on or
    after the crossing date (a NULL date makes that condition false)."""
    euro, n = in_base(bonuses, "winning_amount", rates, p), F.col("n")
    pos = euro.positive()
    vip = pos & (F.col("bonus_date") >= F.col("date_of_reaching_1k"))
    return [
        *[c.alias(name) for name, c in euro.times(n, _scale(bonuses, p)).total().named("_spent").items()],
        F.sum(F.when(pos, n).otherwise(F.lit(0))).alias("bonus_count"),
        F.sum(F.when(vip, n).otherwise(F.lit(0))).alias("vip_bonus_count"),
    ]


def expense_columns(spent: DataFrame, bonuses: DataFrame, p: ReportParams, times: Column) -> dict[str, Column]:
    """The reports' columns from :func:`expense_exprs`, ``times`` over; NULL where
    nothing was spent."""
    money = Money.column("_spent", spent.columns, _scale(bonuses, p))
    some = money.positive()
    return {
        "mkt_expense": money.times(times, _scale(bonuses, p)).only(some).double(),
        "bonus_count": F.when(some, F.col("bonus_count") * times),
        "vip_bonus_count": F.when(some, F.col("vip_bonus_count") * times),
    }


def bonus_expense(
    bonuses: DataFrame, customers: DataFrame, rates: DataFrame, crossing: DataFrame, p: ReportParams,
    attributes: DataFrame | None = None,
) -> DataFrame:
    """Per customer: bonus expense, count of positive bonuses, and count of
    positive bonuses on/after the crossing date; customers with expense > 0.

    The joins that can repeat a bonus are kept: every rate row of the customer's
    currency, and every attribute row of the customer (``attributes``; counted
    per customer and multiplied in). The other lookups have unique keys and
    change nothing.
    """
    b = customers.select(F.col("id").alias("_cid"), "currency_fk")
    r = rates.select(F.col("id").alias("_rid"), "rate_to_eur")
    h = crossing.select(F.col("client_id").alias("_hcid"), "date_of_reaching_1k")
    pre = won_bonuses(bonuses)
    j = (
        pre.join(b, pre.client_id == b._cid, "left")
        .join(r, F.col("currency_fk") == r._rid, "left")
        .join(h, pre.client_id == h._hcid, "left")
    )
    out = j.groupBy("client_id").agg(*expense_exprs(bonuses, rates, p))
    times = F.lit(1).cast("bigint")
    if attributes is not None:
        rows = attributes.groupBy(F.col("client_id").alias("_acid")).agg(F.count(F.lit(1)).alias("_times"))
        out = out.join(rows, out.client_id == rows._acid, "left")
        times = F.coalesce("_times", F.lit(1))
    out = out.withColumns(expense_columns(out, bonuses, p, times)).filter(F.col("mkt_expense").isNotNull())
    return out.select("client_id", "mkt_expense", "bonus_count", "vip_bonus_count")

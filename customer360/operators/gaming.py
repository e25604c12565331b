"""Gaming activity: revenue horizons, average bet, payout, last active day, top product.

Input ``days``: game-day summary rows ``client_id, summary_day, bet_amount,
bets_count, ggr, ngr, returns_amount`` (several rows per customer and day are
allowed). Input ``plays``: ``client_id, provider_name, product_name,
played_count, summary_day``.

Each ``*_exprs`` function returns aggregate columns over ``days`` so a report
can compute all customer-level gaming metrics in a single
``groupBy(client_id)`` (one scan, one shuffle after map-side partial
aggregation); the single-purpose functions wrap them for standalone use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from customer360.config import ReportParams
from customer360.functions.expressions import (
    days_since,
    horizon_money,
    horizon_sum,
    money_sum,
    money_units,
    on_or_after,
    present_in,
    ratio,
    units_to_money,
    within,
)

LIFETIME = "lft"


def _dd(p: ReportParams) -> Column:
    return days_since(p.asof, "summary_day")


def daily_revenue(days: DataFrame, p: ReportParams) -> DataFrame:
    """Per customer and day: NGR, stakes, games, GGR, returns (sums)."""
    return (
        days.groupBy("client_id", "summary_day")
        .agg(
            money_sum("ngr").alias("ngr"),
            money_sum("bet_amount").alias("bets"),
            F.sum("bets_count").alias("games"),
            money_sum("ggr").alias("ggr"),
            money_sum("returns_amount").alias("returns_1"),
        )
        .withColumn("date_diff_rev", days_since(p.asof, "summary_day"))
    )


def revenue_exprs(p: ReportParams, ggr_horizons: bool = True) -> list[Column]:
    """NGR per horizon and lifetime; GGR per horizon (optional) and lifetime."""
    dd = _dd(p)
    ngr, ggr = money_units("ngr"), money_units("ggr")
    out = [horizon_money(dd, "ngr", n, ngr).alias(f"ngr_{n}_days") for n in p.horizons]
    out.append(units_to_money(F.sum(ngr)).alias("ngr_lifetime"))
    if ggr_horizons:
        out += [horizon_money(dd, "ggr", n, ggr).alias(f"ggr_{n}_days") for n in p.horizons]
    out.append(units_to_money(F.sum(ggr)).alias("ggr_lifetime"))
    return out


def avg_bet_exprs(p: ReportParams, amount: str = "bet_amount", count: str = "bets_count") -> list[Column]:
    """Stake per bet in each horizon; NULL when the horizon has no bets."""
    dd = _dd(p)
    units = money_units(amount)
    return [ratio(horizon_money(dd, amount, n, units), horizon_sum(dd, count, n)).alias(f"avg_bet_{n}_days")
            for n in p.horizons]


def payout_expr(returns: str = "returns_amount", stakes: str = "bet_amount") -> Column:
    """Returns over stakes (lifetime)."""
    return ratio(money_sum(returns), money_sum(stakes)).alias("payout_percent")


def last_bet_expr(measure: str) -> Column:
    """Latest day with a positive ``measure`` (NULL if none)."""
    return F.max(F.when(F.col(measure) > 0, F.col("summary_day"))).alias("last_bet_date")


def revenue_horizons(days: DataFrame, p: ReportParams, ggr_horizons: bool = True) -> DataFrame:
    return days.groupBy("client_id").agg(*revenue_exprs(p, ggr_horizons))


def avg_bet_horizons(days: DataFrame, p: ReportParams, amount: str = "bet_amount", count: str = "bets_count") -> DataFrame:
    return days.groupBy("client_id").agg(*avg_bet_exprs(p, amount, count))


def payout_percent(days: DataFrame) -> DataFrame:
    return days.groupBy("client_id").agg(payout_expr())


def last_active_day(days: DataFrame, measure: str = "bets_count") -> DataFrame:
    """Customers with a positive ``measure`` on some day, and the latest such day.

    The filter runs before the grouping, so it is pushed to the scan.
    """
    return (
        days.filter(F.col(measure) > 0)
        .groupBy("client_id")
        .agg(F.max("summary_day").alias("last_bet_date"))
    )


def avg_games_per_active_day(days: DataFrame, games: str = "bets_count") -> DataFrame:
    """Games per distinct active day (exact distinct count)."""
    return days.groupBy("client_id").agg(
        ratio(F.sum(games), F.count_distinct("summary_day")).alias("avg_games_cnt")
    )


def _horizon_name(h) -> str:
    return LIFETIME if h == LIFETIME else f"{h}d"


def product_plays(plays: DataFrame, p: ReportParams, horizons: Sequence = (LIFETIME, 7, 30, 90)) -> DataFrame:
    """Plays per customer and (provider, product), for each horizon, in one pass.

    ``bets_<h>`` is the sum of plays in horizon ``h``; ``in_<h>`` is 1 if the
    product has any row in the horizon (a product without rows in a horizon
    is not a candidate there, even when its plays are NULL).
    """
    dd = _dd(p)
    aggs = []
    for h in horizons:
        name = _horizon_name(h)
        if h == LIFETIME:
            aggs += [F.sum("played_count").alias(f"bets_{name}"), F.max(F.lit(1)).alias(f"in_{name}")]
        else:
            aggs += [
                F.sum(F.when(within(dd, h), F.col("played_count"))).alias(f"bets_{name}"),
                present_in(dd, h).alias(f"in_{name}"),
            ]
    return plays.groupBy("client_id", "provider_name", "product_name").agg(*aggs)


def _rank_key(bets: Column) -> Column:
    """Sort key of a candidate: most plays first (NULL plays first, as a
    descending sort in the source database), then provider, then product."""
    return F.struct(
        bets.isNotNull().alias("k0"),
        (-bets).alias("k1"),
        F.col("provider_name").alias("provider_name"),
        F.col("product_name").alias("product_name"),
        bets.alias("bets"),
    )


def top_products(plays: DataFrame, p: ReportParams, horizons: Sequence = (LIFETIME, 7, 30, 90)) -> DataFrame:
    """Most played (provider, product) per customer for each horizon.

    Equivalent to ``row_number() over (partition by client order by bets desc
    nulls first, provider, product) = 1`` per horizon, computed as one
    ``min(struct(key...))`` aggregation per customer: the minimum is
    associative, so it is partially aggregated before the shuffle and a
    customer with a huge catalogue never sorts in a single task. Customers
    without any row in a horizon get NULLs for it.
    Columns per horizon: ``top_provider_<h>``, ``top_played_game_<h>``,
    ``bets_on_top_game_<h>``.
    """
    return rank_products(product_plays(plays, p, horizons), horizons)


def rank_products(pp: DataFrame, horizons: Sequence) -> DataFrame:
    """The ranking of :func:`top_products` over :func:`product_plays`."""
    best = []
    for h in horizons:
        name = _horizon_name(h)
        cand = F.when(F.col(f"in_{name}").isNotNull(), _rank_key(F.col(f"bets_{name}")))
        best.append(F.min(cand).alias(f"_best_{name}"))
    agg = pp.groupBy("client_id").agg(*best)
    cols = [F.col("client_id")]
    for h in horizons:
        name = _horizon_name(h)
        b = F.col(f"_best_{name}")
        cols += [
            b["provider_name"].alias(f"top_provider_{name}"),
            b["product_name"].alias(f"top_played_game_{name}"),
            b["bets"].alias(f"bets_on_top_game_{name}"),
        ]
    return agg.select(*cols)


def top_product(plays: DataFrame, p: ReportParams, horizon=LIFETIME) -> DataFrame:
    """Top product of one horizon; only customers with a row in the horizon."""
    name = _horizon_name(horizon)
    src = plays if horizon == LIFETIME else plays.filter(on_or_after("summary_day", p.asof, horizon))
    return (
        top_products(src, p, (horizon,))
        .select(
            "client_id",
            F.col(f"top_provider_{name}").alias("provider_name"),
            F.col(f"top_played_game_{name}").alias("product_name"),
            F.col(f"bets_on_top_game_{name}").alias("bets"),
        )
    )

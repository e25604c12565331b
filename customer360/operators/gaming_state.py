"""Gaming metrics carried forward from day to day.

The reports' gaming metrics need every game day ever played, but only the last
``max(horizons)`` days one by one: what is older counts for the lifetime alone. The
state holds just that:

* ``days``: totals per customer and day of the recent days (future ones, too);
* ``lifetime``: totals per customer of all older and undated rows;
* ``plays`` and ``plays_lifetime``: the same per customer and product.

A daily run adds the rows that arrived since the last one, whatever their day,
then moves the days that left the window into the lifetime tables. A run reads the
state and the day's arrivals, not the history. All tables are sums, counts and
maxima, so late rows and several runs a day need no special care; a row must
arrive once. Corrections arrive as rows with the difference.

Each table is aggregated by its keys, partially before the shuffle, so a customer
with a third of all rows is collapsed map-side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from customer360.config import ReportParams
from customer360.functions.expressions import days_since, ratio, units_to_money, within
from customer360.operators.gaming import LIFETIME, rank_products

#: Summed columns of a game day; the last two are days on which the customer was active.
SUMS = ("ngr", "ggr", "bet_amount", "returns_amount", "bets_count")
LAST = {"last_count_day": "bets_count", "last_bet_day": "bet_amount"}
PRODUCT = ("client_id", "provider_name", "product_name")
TABLES = ("days", "lifetime", "plays", "plays_lifetime")


@dataclass(frozen=True)
class GamingState:
    """The four tables of the state."""

    days: DataFrame
    lifetime: DataFrame
    plays: DataFrame
    plays_lifetime: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {t: getattr(self, t) for t in TABLES}


def window_start(p: ReportParams) -> dt.date:
    """The oldest day that a horizon of this run, or of any later one, can reach."""
    return p.asof - dt.timedelta(days=max(*p.horizons, *p.product_horizons))


def _wide(c: Column, kind) -> Column:
    """Money as it is stored: room for sums of sums at the declared scale."""
    return c.cast(DecimalType(38, kind.scale)) if isinstance(kind, DecimalType) else c


def _totals(rows: DataFrame, keys: Sequence[str], sums: Sequence[str], latest: Sequence[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in rows.schema}
    aggs = [_wide(F.sum(c), kinds[c]).alias(c) for c in sums] + [F.max(c).alias(c) for c in latest]
    return rows.groupBy(*keys).agg(*aggs, F.sum("rows").alias("rows"))


def _day_rows(game_days: DataFrame) -> DataFrame:
    active = [F.when(F.col(m) > 0, F.col("summary_day")).alias(c) for c, m in LAST.items()]
    # Job A's game days have no returns.
    sums = [F.col(c) if c in game_days.columns else F.lit(None).cast("double").alias(c) for c in SUMS]
    return game_days.select("client_id", "summary_day", *sums, *active, F.lit(1).cast("bigint").alias("rows"))


def _play_rows(plays: DataFrame) -> DataFrame:
    return plays.select(*PRODUCT, "summary_day", "played_count", F.lit(1).cast("bigint").alias("rows"))


def advance(state: GamingState | None, game_days: DataFrame, plays: DataFrame, p: ReportParams) -> GamingState:
    """The state after the arrival of ``game_days`` and ``plays`` (raw rows of any
    days), with the window of ``p.asof``. ``state=None`` starts from these rows."""
    old = F.col("summary_day").isNull() | (F.col("summary_day") < F.lit(window_start(p)))

    def merged(own: DataFrame | None, life: DataFrame | None, arrived: DataFrame, keys: Sequence[str], sums, latest) -> tuple[DataFrame, DataFrame]:
        dated = [*keys, "summary_day"]
        everything = arrived if own is None else arrived.unionByName(own)
        days = _totals(everything, dated, sums, latest)
        expired = days.where(old).drop("summary_day")
        lifetime = _totals(expired if life is None else expired.unionByName(life), keys, sums, latest)
        return days.where(~old), lifetime

    s = state
    days, lifetime = merged(s and s.days, s and s.lifetime, _day_rows(game_days), ["client_id"], SUMS, list(LAST))
    own, life = merged(s and s.plays, s and s.plays_lifetime, _play_rows(plays), PRODUCT, ["played_count"], [])
    return GamingState(days, lifetime, own, life)


def _all_days(state: GamingState) -> DataFrame:
    """Lifetime rows and day rows together; a lifetime row has no day, and so
    counts in no horizon, as an old or undated row does."""
    return state.days.unionByName(state.lifetime, allowMissingColumns=True)


def gaming_metrics(state: GamingState, p: ReportParams, active: str = "last_count_day", ggr_horizons: bool = True) -> DataFrame:
    """Per customer: NGR and GGR (horizons and lifetime), stake per bet, payout and
    the last active day, equal to those of the raw rows of ``gaming``."""
    dd = days_since(p.asof, "summary_day")

    def in_horizon(c: str, n: int) -> Column:
        return F.sum(F.when(within(dd, n), F.col(c)).otherwise(F.lit(0)))

    aggs = [units_to_money(in_horizon("ngr", n)).alias(f"ngr_{n}_days") for n in p.horizons]
    if ggr_horizons:
        aggs += [units_to_money(in_horizon("ggr", n)).alias(f"ggr_{n}_days") for n in p.horizons]
    aggs += [units_to_money(F.sum(c)).alias(f"{c}_lifetime") for c in ("ngr", "ggr")]
    aggs += [ratio(units_to_money(in_horizon("bet_amount", n)), in_horizon("bets_count", n)).alias(f"avg_bet_{n}_days") for n in p.horizons]
    aggs.append(ratio(units_to_money(F.sum("returns_amount")), units_to_money(F.sum("bet_amount"))).alias("payout_percent"))
    aggs.append(F.max(active).alias("last_bet_date"))
    return _all_days(state).groupBy("client_id").agg(*aggs)


def top_products(state: GamingState, p: ReportParams, horizons: Sequence = (LIFETIME, 7, 30, 90)) -> DataFrame:
    """Most played product per customer and horizon, equal to ``gaming.top_products`` of the raw rows."""
    rows = state.plays.unionByName(state.plays_lifetime, allowMissingColumns=True)
    dd = days_since(p.asof, "summary_day")
    aggs = []
    for h in horizons:
        name = LIFETIME if h == LIFETIME else f"{h}d"
        here = F.lit(True) if h == LIFETIME else within(dd, h)
        aggs += [F.sum(F.when(here, F.col("played_count"))).alias(f"bets_{name}"), F.max(F.when(here, F.lit(1))).alias(f"in_{name}")]
    return rank_products(rows.groupBy(*PRODUCT).agg(*aggs), horizons)


def from_tables(tables: Mapping[str, DataFrame]) -> GamingState:
    """The state from its stored tables."""
    return GamingState(*[tables[t] for t in TABLES])


def stored_rows(state: GamingState) -> DataFrame:
    """Raw rows that the state stands for, per table: a check that none was lost or taken twice."""
    parts = [df.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).withColumn("table", F.lit(t)) for t, df in state.tables().items()]
    return reduce(DataFrame.unionByName, parts)

"""Registered queries: one per operator, each run over the whole test tables.

Every entry is ``(spark, sf_dir) -> DataFrame`` over :class:`Fixtures`
(the driver tables mapped to the report's logical tables) with the fixed
test parameters below. The matching SQL oracle lives in ``oracle_queries.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from customer360 import operators as ops
from customer360.config import ReportParams
from customer360.functions.formatting import blocked_flag, decode_utf8
from customer360.operators.gaming import LIFETIME
from customer360.operators.reports import flow_horizons_eur, gaming_b
from customer360.sources.fixtures import ASOF, Fixtures
from customer360.sources.sinks import with_report_label

# Fixed test parameters (see FIXTURES.md).
REPORT_A_NAME = "report_a"
CURRENCY_CODES = ("CAD", "USDT", "BRL", "EUR", "NZD", "USD", "AUD", "GBP", "XXX")
PARAMS_A = ReportParams(asof=ASOF, vip_min_amount=1_000_000, vip_min_count=5)
PARAMS_B = ReportParams(asof=ASOF, crossing_amount=300_000)

Query = Callable[[SparkSession, str], DataFrame]


def _fx(spark, sf_dir) -> Fixtures:
    return Fixtures.shared(spark, sf_dir)


def _money_out(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def report_a(spark, sf_dir) -> DataFrame:
    f = _fx(spark, sf_dir)
    return ops.report_a(f.customers(), f.transactions(), f.game_days(), f.game_plays(), PARAMS_A)


def report_b(spark, sf_dir, binary_email: bool = False) -> DataFrame:
    f = _fx(spark, sf_dir)
    cust = f.customers()
    if binary_email:
        cust = cust.withColumn("email", F.encode("email", "UTF-8"))
    return ops.report_b(
        f.attributes(), cust, f.merchants(), f.countries(), f.languages(), f.transactions(),
        f.currencies(), f.game_days(), f.balances(), f.bonuses(), PARAMS_B,
    )


def _crossing(f: Fixtures) -> DataFrame:
    return ops.threshold_crossing(f.transactions(), f.currencies(), PARAMS_B)


def _top(h) -> Query:
    return lambda spark, d: ops.top_product(_fx(spark, d).game_plays(), PARAMS_A, h)


def _kpi(spark, sf_dir) -> DataFrame:
    f = _fx(spark, sf_dir)
    base = f.attributes().select("client_id")
    wide = ops.kpi_ratios(
        base.join(gaming_b(f.game_days(), PARAMS_B), "client_id", "left").join(
            flow_horizons_eur(f.transactions(), f.currencies(), PARAMS_B), "client_id", "left"
        ),
        PARAMS_B,
    )
    keep = [f"ngr_deposits_{n}_days" for n in PARAMS_B.horizons] + ["deposit_payout_percent", "net_deposits"]
    return wide.select("client_id", *keep)


def _fx_out(df: DataFrame) -> DataFrame:
    return _money_out(df, ["amount", "rate_to_eur", "amount_eur"])


QUERIES: dict[str, Query] = {
    # sources
    "scan_contacts": lambda s, d: _fx(s, d).last_contacts(),
    "contact_enrichment": lambda s, d: ops.contact_enrichment(
        ops.round_metrics(report_b(s, d, binary_email=True), PARAMS_B), _fx(s, d).last_contacts(), sized_by=_fx(s, d).customers()
    ),
    "report_label": lambda s, d: with_report_label(
        ops.vip_cohort(_fx(s, d).transactions(), PARAMS_A).select("client_id"), PARAMS_A.asof, REPORT_A_NAME
    ),
    # filters and flows
    "filter_approved": lambda s, d: _money_out(
        ops.filter_approved(_fx(s, d).transactions(), PARAMS_A, PARAMS_A.deposit_type), ["amount"]
    ),
    "daily_deposits": lambda s, d: ops.daily_flow(_fx(s, d).transactions(), PARAMS_A, PARAMS_A.deposit_type, "dpst"),
    "daily_withdrawals": lambda s, d: ops.daily_flow(
        _fx(s, d).transactions(), PARAMS_A, PARAMS_A.withdrawal_type, "wtdrl"
    ),
    "deposit_horizons": lambda s, d: ops.deposit_horizons(_fx(s, d).transactions(), PARAMS_A),
    "withdrawal_horizons": lambda s, d: ops.withdrawal_horizons(_fx(s, d).transactions(), PARAMS_A),
    "cumulative_deposits": lambda s, d: ops.cumulative_flow(_fx(s, d).transactions(), PARAMS_A),
    "vip_qualification_date": lambda s, d: ops.qualification_date(_fx(s, d).transactions(), PARAMS_A),
    "vip_cohort": lambda s, d: ops.vip_cohort(_fx(s, d).transactions(), PARAMS_A),
    # gaming
    "daily_revenue": lambda s, d: ops.daily_revenue(_fx(s, d).game_days(), PARAMS_B),
    "revenue_horizons": lambda s, d: ops.revenue_horizons(_fx(s, d).game_days(), PARAMS_A),
    "avg_bet_horizons": lambda s, d: ops.avg_bet_horizons(_fx(s, d).game_days(), PARAMS_A),
    "payout_percent": lambda s, d: ops.payout_percent(_fx(s, d).game_days()),
    "last_active_day": lambda s, d: ops.last_active_day(_fx(s, d).game_days(), "bets_count"),
    "avg_games_per_active_day": lambda s, d: ops.avg_games_per_active_day(_fx(s, d).game_days()),
    "product_plays": lambda s, d: ops.product_plays(_fx(s, d).game_plays(), PARAMS_A),
    "top_product_lft": _top(LIFETIME),
    "top_product_7d": _top(7),
    "top_product_30d": _top(30),
    "top_product_90d": _top(90),
    "currency_case_rate": lambda s, d: ops.currency_case_rate(
        _money_out(_fx(s, d).game_days(), ["bet_amount", "ggr", "ngr", "returns_amount"]).withColumn(
            "currency_id",
            F.element_at(F.array(*[F.lit(c) for c in CURRENCY_CODES]), (F.col("client_id") % 9 + 1).cast("int")),
        )
    ),
    # currencies and milestones
    "fx_normalise": lambda s, d: _fx_out(ops.fx_normalise(_fx(s, d).transactions(), _fx(s, d).currencies(), PARAMS_B)),
    "fx_normalise_valid": lambda s, d: _fx_out(
        ops.fx_normalise_valid(_fx(s, d).transactions(), _fx(s, d).currencies(), PARAMS_B)
    ),
    "net_deposits": lambda s, d: ops.net_deposits(
        ops.fx_normalise(_fx(s, d).transactions(), _fx(s, d).currencies(), PARAMS_B), PARAMS_B
    ),
    "cumulative_deposits_eur": lambda s, d: ops.cumulative_deposits_eur(
        _fx(s, d).transactions(), _fx(s, d).currencies(), PARAMS_B
    ),
    "threshold_crossing_eur": lambda s, d: _crossing(_fx(s, d)),
    # customers
    "customer_recency": lambda s, d: ops.customer_recency(_fx(s, d).customers(), PARAMS_A),
    "customer_dimension": lambda s, d: ops.customer_dimension(
        _fx(s, d).attributes(), _fx(s, d).customers(), _fx(s, d).merchants(), _fx(s, d).countries(),
        _fx(s, d).languages(), PARAMS_B,
    ),
    "latest_balance": lambda s, d: ops.latest_balance(_fx(s, d).balances()),
    "blocked_flag": lambda s, d: _fx(s, d).customers().select("id", blocked_flag("email").alias("is_blocked")),
    "decode_email": lambda s, d: _fx(s, d)
    .customers()
    .select("id", F.encode("email", "UTF-8").alias("email"))
    .select("id", decode_utf8("email").alias("email")),
    # bonus
    "bonus_enriched": lambda s, d: ops.bonus_enriched(
        _fx(s, d).bonuses(), _fx(s, d).customers(), _fx(s, d).currencies(), _fx(s, d).bonus_defs(),
        _fx(s, d).merchants(), _fx(s, d).attributes(), _fx(s, d).countries(), _crossing(_fx(s, d)), PARAMS_B,
    ),
    "bonus_expense": lambda s, d: ops.bonus_expense(
        _fx(s, d).bonuses(), _fx(s, d).customers(), _fx(s, d).currencies(), _crossing(_fx(s, d)), PARAMS_B,
        attributes=_fx(s, d).attributes(),
    ),
    # reports
    "kpi_ratios": _kpi,
    "report_a": report_a,
    "format_money": lambda s, d: ops.format_money(report_a(s, d), PARAMS_A),
    "report_b": report_b,
    "round_metrics": lambda s, d: ops.round_metrics(report_b(s, d), PARAMS_B),
}

"""Report operators: each is a function of DataFrames returning a DataFrame."""

from customer360.operators.bonus import bonus_enriched, bonus_expense
from customer360.operators.customers import customer_dimension, customer_recency, latest_balance, latest_rows, merge_latest, shown_balance
from customer360.operators.flows import (
    cumulative_flow,
    daily_flow,
    deposit_horizons,
    filter_approved,
    flow_daily,
    flow_horizons,
    flow_summary,
    id_zones,
    net_deposits,
    qualification_date,
    repeated_id_days,
    vip_cohort,
    withdrawal_horizons,
)
from customer360.operators.fx import currency_case_rate, fx_normalise, fx_normalise_valid
from customer360.operators.gaming import (
    avg_bet_horizons,
    avg_games_per_active_day,
    daily_revenue,
    last_active_day,
    payout_percent,
    product_plays,
    revenue_horizons,
    top_product,
    top_products,
)
from customer360.operators.ledger import cohort_ledger, ledger
from customer360.operators.milestones import cumulative_deposits_eur, threshold_crossing
from customer360.operators.presentation import contact_enrichment, format_money, round_metrics
from customer360.operators.reports import cohort_flows, kpi_ratios, report_a, report_b

__all__ = [
    "cohort_flows",
    "cohort_ledger",
    "avg_bet_horizons",
    "avg_games_per_active_day",
    "bonus_enriched",
    "bonus_expense",
    "contact_enrichment",
    "cumulative_deposits_eur",
    "cumulative_flow",
    "currency_case_rate",
    "customer_dimension",
    "customer_recency",
    "daily_flow",
    "daily_revenue",
    "deposit_horizons",
    "filter_approved",
    "flow_daily",
    "flow_horizons",
    "flow_summary",
    "format_money",
    "fx_normalise",
    "fx_normalise_valid",
    "id_zones",
    "kpi_ratios",
    "last_active_day",
    "latest_balance",
    "latest_rows",
    "ledger",
    "merge_latest",
    "net_deposits",
    "payout_percent",
    "product_plays",
    "qualification_date",
    "repeated_id_days",
    "report_a",
    "report_b",
    "revenue_horizons",
    "round_metrics",
    "shown_balance",
    "threshold_crossing",
    "top_product",
    "top_products",
    "vip_cohort",
    "withdrawal_horizons",
]

"""Column-expression helpers (all built-in Spark functions, codegen friendly)."""

from customer360.functions.expressions import (
    days_since,
    horizon_sum,
    money_sum,
    on_or_after,
    present_in,
    ratio,
    to_day,
    within,
)
from customer360.functions.formatting import (
    blocked_flag,
    decode_utf8,
    eur_text,
    report_date,
    round2,
    whole_units,
)

__all__ = [
    "blocked_flag",
    "days_since",
    "decode_utf8",
    "eur_text",
    "horizon_sum",
    "money_sum",
    "on_or_after",
    "present_in",
    "ratio",
    "report_date",
    "round2",
    "to_day",
    "whole_units",
    "within",
]

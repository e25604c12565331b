"""Report presentation: money text, rounding, help-desk contact enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DecimalType, DoubleType, FloatType

from customer360.config import ReportParams
from customer360.functions.formatting import decode_utf8, eur_text, round2
from customer360.operators.flows import DEPOSIT, WITHDRAWAL
from customer360.plans.joins import null_safe_left_join, suffix_overlaps


def money_columns_a(p: ReportParams) -> list[str]:
    """The 28 money columns of report A shown as EUR text."""
    out = []
    for prefix in (DEPOSIT, WITHDRAWAL, "ngr", "ggr"):
        out += [f"{prefix}_{n}_days" for n in p.horizons] + [f"{prefix}_lifetime"]
    return out


def average_bet_columns_a(p: ReportParams) -> list[str]:
    return [f"avg_bet_{n}_days" for n in p.horizons]


def format_money(report: DataFrame, p: ReportParams, money_cols: Sequence[str] | None = None,
                 round_cols: Sequence[str] | None = None) -> DataFrame:
    """Money columns -> whole-euro nl-NL text (NULL as 0), averages rounded to 2."""
    money_cols = money_columns_a(p) if money_cols is None else money_cols
    round_cols = average_bet_columns_a(p) if round_cols is None else round_cols
    cols = {c: eur_text(c) for c in money_cols}
    cols.update({c: round2(c) for c in round_cols})
    return report.withColumns(cols)


def metric_columns_b(p: ReportParams) -> list[str]:
    """The 40 columns of report B rounded to 2 places."""
    h = p.horizons
    return (
        [f"Deposit_{n}_days" for n in h] + ["Total_Deposits_Count", "Deposit_Lifetime"]
        + [f"Withdrawl_{n}_Days" for n in h] + ["Withdrawl_Lifetime"]
        + [f"Avg_Bet_{n}_Days" for n in h]
        + [f"NGR_{n}_Days" for n in h] + ["NGR_lifetime", "GGR_Lifetime"]
        + [f"NGR_Deposits_{n}_Days" for n in h]
        + ["Player_Balance", "Deposit_Payout_Percent", "Payout_Percent", "Net_deposits", "Bonus_Used"]
    )


def round_metrics(report: DataFrame, p: ReportParams, cols: Sequence[str] | None = None) -> DataFrame:
    """Round the fractional metric columns half-to-even to 2 places.

    Integral columns (counts) are unchanged by rounding and left as they are.
    """
    cols = metric_columns_b(p) if cols is None else cols
    fractional = (DoubleType, FloatType, DecimalType)
    types = {f.name: f.dataType for f in report.schema.fields}
    return report.withColumns({c: round2(c) for c in cols if isinstance(types[c], fractional)})


def contact_enrichment(
    report: DataFrame,
    contacts: DataFrame,
    key: str = "email",
    contact_key: str = "requester_email",
    drop: Sequence[str] = ("index", "email", "requester_email"),
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Attach the last help-desk contact to each report row by e-mail.

    Binary e-mails are decoded as UTF-8 first. The match is a left join in
    which NULL e-mails match NULL contact e-mails (merge semantics: a NULL
    e-mail row gets every NULL-e-mail contact). Columns present on both sides
    get ``_x`` / ``_y`` suffixes; the keys and ``index`` are dropped.
    ``sized_by``: a table with the ``key`` column in which NULL e-mails can be counted
    without computing the report (see :func:`null_safe_left_join`).
    """
    if isinstance(report.schema[key].dataType, BinaryType):
        report = report.withColumn(key, decode_utf8(key))
    if isinstance(contacts.schema[contact_key].dataType, BinaryType):
        contacts = contacts.withColumn(contact_key, decode_utf8(contact_key))
    left, right = suffix_overlaps(report, contacts, [key, contact_key])
    joined = null_safe_left_join(left, right, key, contact_key, sized_by=sized_by)
    # By exact name: DataFrame.drop would also take a column that differs in case.
    return joined.select([F.col(f"`{c}`") for c in joined.columns if c not in set(drop)])

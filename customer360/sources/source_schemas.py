"""Tables as the two source jobs store them -> the library's logical tables.

The source jobs read operator tables whose columns use other names (quoted
camel case in job A, snake case with ``_fk`` keys in job B) and other codes
(job A: statuses 'Approved' / 'ApprovedManually', type 2 deposit, 1
withdrawal; job B: 'APPROVED' / 'SUCCESSFUL', 'DEPOSIT' / 'WITHDRAWAL').
:func:`to_logical` renames the columns of caller-supplied tables (read with
``spark.read`` or :func:`customer360.sources.read_jdbc`, table names are the
caller's), and :func:`job_a_params` / :func:`job_b_params` give the matching
codes and thresholds. Renaming is a projection, so it costs nothing at run
time and filters still reach the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from customer360.config import ReportParams

# Source column name -> logical column name, per logical table.
JOB_A_COLUMNS: dict[str, dict[str, str]] = {
    "customers": {
        "Id": "id", "Email": "email", "FirstName": "first_name", "LastName": "last_name",
        "MobileNumber": "mobile_number", "CountryName": "country_name", "LanguageId": "language_fk",
        "BirthDate": "birth_date", "AffiliateId": "affiliate_id", "PartnerId": "partner_id",
        "CreationTime": "created_on", "LastSessionDate": "last_session_on", "StateName": "state_name",
    },
    "transactions": {
        "Id": "id", "ClientId": "client_id", "UserName": "user_name", "CreationTime": "txn_date",
        "ConvertedAmount": "amount", "Status": "status", "Type": "txn_type",
    },
    "game_days": {
        "ClientId": "client_id", "CurrencyId": "currency_id", "summary_day": "summary_day",
        "TotalBetAmount": "bet_amount", "TotalBetsCount": "bets_count", "GGR": "ggr", "NGR": "ngr",
    },
    "game_plays": {
        "ClientId": "client_id", "ProviderName": "provider_name", "ProductName": "product_name",
        "PlayedCount": "played_count", "summary_day": "summary_day",
    },
}
JOB_B_COLUMNS: dict[str, dict[str, str]] = {
    "attributes": {"customer_fk": "client_id", "referral_info": "referral_info", "full_reg_complete": "registered_on"},
    "customers": {
        "id": "id", "merchant_fk": "merchant_fk", "country_fk": "country_fk", "language_fk": "language_fk",
        "currency_fk": "currency_fk", "last_activity_time": "last_session_on", "email": "email", "login": "login",
    },
    "merchants": {"id": "id", "name": "name"},
    "countries": {"id": "id", "country_desc": "country_desc"},
    "languages": {"id": "id", "lang_desc": "lang_desc"},
    "transactions": {
        "id": "id", "customer_fk": "client_id", "currency_fk": "currency_fk", "c_date": "txn_date",
        "amount": "amount", "trx_type": "txn_type", "status": "status",
    },
    "currencies": {"id": "id", "rate_to_eur": "rate_to_eur", "is_valid": "is_valid"},
    "game_days": {
        "customer_fk": "client_id", "summary_day": "summary_day", "NGR_base_currency": "ngr",
        "GGR_base_currency": "ggr", "total_stakes_base_currency": "bet_amount",
        "total_returns_base_currency": "returns_amount", "finished_games_real_money": "bets_count",
    },
    "balances": {"customer_fk": "client_id", "summary_day": "summary_day", "balance_base_currency": "balance"},
    "bonuses": {
        "id": "id", "customer_fk": "client_id", "bonus_fk": "bonus_fk", "merchant_fk": "merchant_fk",
        "c_date": "bonus_date", "winning_amount": "winning_amount", "status": "status",
    },
    "bonus_defs": {"id": "id", "promo_code": "promo_code", "description": "description"},
    "last_contacts": {"requester_email": "requester_email"},
}
# Logical columns that no report reads.
OPTIONAL = {"currency_id"}
# Codes and thresholds of the two jobs.
JOB_A_STATUSES = ("Approved", "ApprovedManually")
JOB_A_TYPES = (2, 1)  # deposit, withdrawal
JOB_A_VIP_MIN_AMOUNT, JOB_A_VIP_MIN_COUNT = 200, 5
JOB_B_STATUSES = ("APPROVED", "SUCCESSFUL")
JOB_B_TYPES = ("DEPOSIT", "WITHDRAWAL")
JOB_B_CROSSING_AMOUNT = 1000


# What the reports do with a logical column, wherever it stands: add it up,
# compare it with days, or read it as text.
COLUMN_KINDS = {
    "number": ("amount", "bet_amount", "bets_count", "ggr", "ngr", "returns_amount", "played_count", "balance", "winning_amount", "rate_to_eur"),
    "day": ("txn_date", "summary_day", "created_on", "last_session_on", "registered_on", "bonus_date"),
    "text": ("status", "email", "requester_email", "user_name", "login"),
}
_TYPES = {"number": T.NumericType, "day": (T.DateType, T.TimestampType, T.TimestampNTZType), "text": (T.StringType, T.BinaryType)}


def check_columns(tables: Mapping[str, DataFrame], p: ReportParams) -> None:
    """Raise if a logical table has a column of another kind than the reports need, or
    transaction types of another kind than the parameters' codes: such data would
    give an empty or wrong report without an error. Looks at schemas alone."""
    wrong = []
    for name, df in tables.items():
        kinds = {f.name: f.dataType for f in df.schema}
        for kind, columns in COLUMN_KINDS.items():
            wrong += [f"{name}.{c} is {kinds[c].simpleString()}, not a {kind}" for c in columns if c in kinds and not isinstance(kinds[c], _TYPES[kind])]
        if name == "transactions" and "txn_type" in kinds:
            for code in (p.deposit_type, p.withdrawal_type):
                if isinstance(code, str) != isinstance(kinds["txn_type"], T.StringType):
                    wrong.append(f"{name}.txn_type is {kinds['txn_type'].simpleString()}, but its code is {code!r}")
    if wrong:
        raise ValueError("; ".join(wrong))


def job_a_params(asof: dt.date | None = None, **overrides) -> ReportParams:
    kw = dict(approved_statuses=JOB_A_STATUSES, deposit_type=JOB_A_TYPES[0], withdrawal_type=JOB_A_TYPES[1],
              vip_min_amount=JOB_A_VIP_MIN_AMOUNT, vip_min_count=JOB_A_VIP_MIN_COUNT)
    if asof is not None:
        kw["asof"] = asof
    kw.update(overrides)
    return ReportParams(**kw)


def job_b_params(asof: dt.date | None = None, **overrides) -> ReportParams:
    kw = dict(approved_statuses=JOB_B_STATUSES, deposit_type=JOB_B_TYPES[0], withdrawal_type=JOB_B_TYPES[1],
              crossing_amount=JOB_B_CROSSING_AMOUNT)
    if asof is not None:
        kw["asof"] = asof
    kw.update(overrides)
    return ReportParams(**kw)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the mapped columns; other columns are kept. A mapped column that
    ``df`` lacks under either name is an error."""
    missing = [k for k, v in mapping.items() if k not in df.columns and v not in df.columns and v not in OPTIONAL]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def to_logical(tables: Mapping[str, DataFrame], job: str) -> dict[str, DataFrame]:
    """Source-shaped tables (keyed by logical table name) -> logical tables."""
    columns = {"a": JOB_A_COLUMNS, "b": JOB_B_COLUMNS}[job]
    out = {}
    for name, df in tables.items():
        try:
            out[name] = rename_columns(df, columns.get(name, {}))
        except ValueError as e:
            raise ValueError(f"table {name}: {e}") from e
    return out

"""Customer-level attributes: recency, dimension lookups, latest balance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from customer360.config import ReportParams
from customer360.functions.expressions import days_since, to_day


def customer_recency(customers: DataFrame, p: ReportParams) -> DataFrame:
    """Registration and last-login day, and the days elapsed since each."""
    return customers.select(
        "id",
        to_day("created_on").alias("registration_date"),
        days_since(p.asof, "created_on").alias("days_since_register"),
        to_day("last_session_on").alias("last_login_date"),
        days_since(p.asof, "last_session_on").alias("days_since_last_login"),
    )


def customer_dimension(
    attributes: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    countries: DataFrame,
    languages: DataFrame,
    p: ReportParams,
) -> DataFrame:
    """Customer attributes with brand, country and language names and recency.

    Left lookups: a missing customer or dimension row leaves NULLs. The three
    dimensions are small, bounded tables; Spark broadcasts them when their
    measured size is under the broadcast threshold.
    """
    a = attributes.select("client_id", "referral_info", "registered_on")
    b = customers.select(
        F.col("id").alias("_cid"), "merchant_fk", "country_fk", "language_fk", "last_session_on", "email", "login"
    )
    m = merchants.select(F.col("id").alias("_mid"), F.col("name").alias("merchant_name"))
    c = countries.select(F.col("id").alias("_ctid"), "country_desc")
    lg = languages.select(F.col("id").alias("_lid"), "lang_desc")
    j = (
        a.join(b, a.client_id == b._cid, "left")
        .join(m, F.col("merchant_fk") == m._mid, "left")
        .join(c, F.col("country_fk") == c._ctid, "left")
        .join(lg, F.col("language_fk") == lg._lid, "left")
    )
    return j.select(
        F.col("client_id").alias("customer_fk"),
        "merchant_name",
        "referral_info",
        "country_desc",
        days_since(p.asof, "last_session_on").alias("days_since_last_login"),
        "lang_desc",
        "email",
        "login",
        days_since(p.asof, "registered_on").alias("days_since_register"),
    )


def latest_rows(balances: DataFrame) -> DataFrame:
    """Rows (``client_id, summary_day, balance``) on each customer's latest snapshot day, ties all kept.

    ``rank() = 1`` over the customer: Spark keeps each task's own latest rows of
    a customer before the shuffle (a window group limit), so one scan suffices
    and a customer with very many snapshots is reduced map-side. Rows without a
    day never count as the latest, nor do rows without a customer.
    """
    w = Window.partitionBy("client_id").orderBy(F.col("summary_day").desc())
    return (
        balances.where("summary_day is not null and client_id is not null")
        .select("client_id", "summary_day", "balance")
        .withColumn("_rank", F.rank().over(w))
        .where("_rank = 1")
        .drop("_rank")
    )


def merge_latest(state: DataFrame | None, arrived: DataFrame) -> DataFrame:
    """:func:`latest_rows` after the arrival of snapshots of any days.

    ``state`` is the former result (None at first). A snapshot that is older than a
    customer's latest changes nothing, one of the same day is a tie, a newer one
    replaces them; so a run reads one row per customer and the day's arrivals."""
    return latest_rows(arrived if state is None else state.unionByName(arrived.select(*state.columns)))


def shown_balance(latest: DataFrame) -> DataFrame:
    """The reports' balance columns of :func:`latest_rows`."""
    return latest.select("client_id", F.col("balance").cast("double").alias("balance_base_currency"))


def latest_balance(balances: DataFrame) -> DataFrame:
    """Balance rows on each customer's latest snapshot day (ties all kept)."""
    return shown_balance(latest_rows(balances))

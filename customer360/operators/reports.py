"""The two wide per-customer reports and their KPI ratios.

Both reports are a star of per-customer frames around a customer table. Each
metric frame is one ``groupBy(client_id)`` over one source (all metrics of a
source in the same aggregation), so a report reads every source once:

* report A: transactions (deposit and withdrawal horizons and the
  running-total VIP date, one pass), game days (revenue, average bet, last
  bet day), plays (four top-product horizons in one aggregation), customers;
* report B: transactions (flows in base currency and crossing date, one pass),
  game days, bonuses, balances, customers and dimensions.

The VIP restriction (A: lifetime rule, B: crossing date) is applied to the
small per-customer frame first and joined inner, so every other join only
carries cohort rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from customer360.config import ReportParams
from customer360.functions.expressions import days_since, ratio
from customer360.functions.money import stored_eur
from customer360.functions.formatting import blocked_flag, decode_utf8
from customer360.operators.bonus import expense_columns, expense_exprs, won_bonuses
from customer360.operators import gaming_state
from customer360.operators.customers import customer_dimension, latest_balance, shown_balance
from customer360.operators.flows import DEPOSIT, WITHDRAWAL, cohort_filter, flow_horizons, flow_summary
from customer360.operators.fx import fx_normalise
from customer360.operators.gaming import LIFETIME, avg_bet_exprs, last_bet_expr, payout_expr, revenue_exprs, top_products
from customer360.operators.gaming_state import GamingState
from customer360.operators.ledger import cohort_ledger
from customer360.plans.joins import left_join_all


def kpi_ratios(wide: DataFrame, p: ReportParams) -> DataFrame:
    """NGR / deposits per horizon, withdrawals / deposits, net deposits.

    Ratios are NULL when either side is NULL or the denominator is 0; net
    deposits stay NULL when one side is absent (no zero fill here).
    """
    cols = {f"ngr_deposits_{n}_days": ratio(f"ngr_{n}_days", f"{DEPOSIT}_{n}_days") for n in p.horizons}
    cols["deposit_payout_percent"] = ratio(f"{WITHDRAWAL}_lifetime", f"{DEPOSIT}_lifetime")
    if "net_deposits" not in wide.columns:  # flows bring the exact difference of the sums
        cols["net_deposits"] = F.col(f"{DEPOSIT}_lifetime") - F.col(f"{WITHDRAWAL}_lifetime")
    return wide.withColumns(cols)


# ---------------------------------------------------------------------------
# Report A
# ---------------------------------------------------------------------------

def report_a_columns(p: ReportParams) -> list[str]:
    """The ordered output labels of report A."""
    h = p.horizons
    return (
        ["Email", "FirstName", "LastName", "MobileNumber", "CountryName", "LanguageId", "BirthDate",
         "AffiliateId", "PartnerId", "registration_date", "days_since_register", "last_login_date",
         "days_since_last_login", "ClientId"]
        + [f"{DEPOSIT}_{n}_days" for n in h]
        + [f"{DEPOSIT}_lifetime", "total_deposits_count", "days_since_last_deposit", "days_since_first_deposit"]
        + [f"{WITHDRAWAL}_{n}_days" for n in h]
        + [f"{WITHDRAWAL}_lifetime", f"{WITHDRAWAL}_count"]
        + [f"ngr_{n}_days" for n in h]
        + [f"ggr_{n}_days" for n in h]
        + [f"avg_bet_{n}_days" for n in h]
        + ["ggr_lifetime", "ngr_lifetime", "days_since_last_bet", "StateName"]
        + [c for hz in ("lft", "7d", "30d", "90d") for c in (f"top_played_game_{hz}", f"bets_on_top_game_{hz}")]
        + ["vip_date"]
    )


def cohort_flows(tx: DataFrame, p: ReportParams, flow_rollup: DataFrame | None = None) -> DataFrame:
    """Flow metrics and VIP date of job A's VIP customers."""
    return flow_summary(tx, p, daily=flow_rollup).filter(cohort_filter(p.vip_min_amount, p.vip_min_count))


def report_a(
    customers: DataFrame, tx: DataFrame, days: DataFrame, plays: DataFrame, p: ReportParams,
    flow_rollup: DataFrame | None = None, flows: DataFrame | None = None, state: GamingState | None = None,
) -> DataFrame:
    """The VIP customer report of job A (63 columns, one row per VIP customer).

    Cohort: lifetime deposits >= ``vip_min_amount`` or deposit count >=
    ``vip_min_count``. ``vip_date`` is the first day the running totals
    cross the same thresholds. With ``flow_rollup`` (a stored
    ``flow_daily`` table) the transactions are not scanned; with ``flows`` (a
    stored :func:`cohort_flows`) nor is the cohort computed. The cohort
    restricts customers, game days and plays by plain semi joins, which Spark
    broadcasts or shuffles by the measured size of the cohort. With ``state``
    (``gaming_state``) neither game days nor plays are read.
    """
    flows = cohort_flows(tx, p, flow_rollup) if flows is None else flows
    ids = flows.select("client_id")
    horizons = (LIFETIME, *p.product_horizons)
    if state is None:
        days, plays = days.join(ids, "client_id", "left_semi"), plays.join(ids, "client_id", "left_semi")
        gaming = days.groupBy("client_id").agg(
            *revenue_exprs(p, ggr_horizons=True), *avg_bet_exprs(p), last_bet_expr("bets_count")
        )
        tops = top_products(plays, p, horizons)
    else:
        own = gaming_state.from_tables({t: df.join(ids, "client_id", "left_semi") for t, df in state.tables().items()})
        gaming, tops = gaming_state.gaming_metrics(own, p), gaming_state.top_products(own, p, horizons)
    cust = customers.select(
        F.col("id").alias("client_id"),
        F.col("email").alias("Email"),
        F.col("first_name").alias("FirstName"),
        F.col("last_name").alias("LastName"),
        F.col("mobile_number").alias("MobileNumber"),
        F.col("country_name").alias("CountryName"),
        F.col("language_fk").alias("LanguageId"),
        F.col("birth_date").alias("BirthDate"),
        F.col("affiliate_id").alias("AffiliateId"),
        F.col("partner_id").alias("PartnerId"),
        F.to_date("created_on").alias("registration_date"),
        days_since(p.asof, "created_on").alias("days_since_register"),
        F.to_date("last_session_on").alias("last_login_date"),
        days_since(p.asof, "last_session_on").alias("days_since_last_login"),
        F.col("state_name").alias("StateName"),
    )
    wide = left_join_all(flows.join(cust, "client_id", "inner"), [gaming, tops], "client_id")
    bets_30 = "bets_on_top_game_7d" if p.reference_compat else "bets_on_top_game_30d"
    bets_90 = "bets_on_top_game_7d" if p.reference_compat else "bets_on_top_game_90d"
    wide = wide.withColumns(
        {
            "ClientId": F.col("client_id"),
            "days_since_last_bet": days_since(p.asof, "last_bet_date"),
            "bets_on_top_game_30d": F.col(bets_30),
            "bets_on_top_game_90d": F.col(bets_90),
        }
    )
    return wide.select(*report_a_columns(p))


# ---------------------------------------------------------------------------
# Report B
# ---------------------------------------------------------------------------

def report_b_columns(p: ReportParams) -> list[tuple[str, str]]:
    """The ordered output labels of report B, each with its internal column."""
    h = p.horizons
    return (
        [("Customer_ID", "customer_fk"), ("Brand", "merchant_name"), ("Affiliate_ID", "referral_info"),
         ("Country", "country_desc"), ("Language", "lang_desc"),
         ("Days_since_last_login", "days_since_last_login"), ("Days_since_last_bet", "days_since_last_bet"),
         ("Days_since_last_deposit", "days_since_last_deposit")]
        + [(f"Deposit_{n}_days", f"{DEPOSIT}_{n}_days") for n in h]
        + [("Total_Deposits_Count", "total_deposits_count"), ("Deposit_Lifetime", f"{DEPOSIT}_lifetime")]
        + [(f"Withdrawl_{n}_Days", f"{WITHDRAWAL}_{n}_days") for n in h]
        + [("Withdrawl_Lifetime", f"{WITHDRAWAL}_lifetime")]
        + [(f"Avg_Bet_{n}_Days", f"avg_bet_{n}_days") for n in h]
        + [(f"NGR_{n}_Days", f"ngr_{n}_days") for n in h]
        + [("NGR_lifetime", "ngr_lifetime"), ("GGR_Lifetime", "ggr_lifetime")]
        + [(f"NGR_Deposits_{n}_Days", f"ngr_deposits_{n}_days") for n in h]
        + [("Player_Balance", "balance_base_currency"), ("Deposit_Payout_Percent", "deposit_payout_percent"),
           ("Payout_Percent", "payout_percent"), ("Net_deposits", "net_deposits"), ("Bonus_Used", "mkt_expense"),
           ("date_of_reaching_1k", "date_of_reaching_1k"), ("is_blocked", "is_blocked"), ("username", "login"),
           ("withdrawl_count", f"{WITHDRAWAL}_count"), ("days_since_first_deposit", "days_since_first_deposit"),
           ("days_since_register", "days_since_register"), ("bonus_count", "bonus_count"),
           ("vip_bonus_count", "vip_bonus_count"), ("email", "email")]
    )


def flow_horizons_eur(tx: DataFrame, rates: DataFrame, p: ReportParams) -> DataFrame:
    """Deposit and withdrawal horizons in base currency (all rate rows)."""
    eur = fx_normalise(tx, rates, p)
    return flow_horizons(eur, p, net="net_deposits", amount=stored_eur(eur, p.fx_extra_digits))


def gaming_b(days: DataFrame, p: ReportParams) -> DataFrame:
    """Report B's gaming metrics in one aggregation."""
    return days.groupBy("client_id").agg(
        *revenue_exprs(p, ggr_horizons=False),
        *avg_bet_exprs(p, "bet_amount", "bets_count"),
        payout_expr(),
        last_bet_expr("bet_amount"),
    )


def _with_bonuses(flows: DataFrame, bonuses: DataFrame, customers: DataFrame, rates: DataFrame, p: ReportParams) -> DataFrame:
    """``flows`` (one row per customer, with its crossing date) plus the customer's
    exact bonus expense and counts, once per rate row.

    The bonuses, counted per customer, day and amount, meet the flows on the
    customer, and the aggregation hands the flows' row on: nothing computes
    the flows a second time to look the crossing date up."""
    pre = won_bonuses(bonuses).withColumnRenamed("client_id", "_bonus_client")
    c = customers.select(F.col("id").alias("_cid"), "currency_fk")
    r = rates.select(F.col("id").alias("_rid"), "rate_to_eur")
    j = (
        flows.join(pre, flows.client_id == pre._bonus_client, "left")
        .join(c, flows.client_id == c._cid, "left")
        .join(r, F.col("currency_fk") == r._rid, "left")
    )
    row = F.struct(*[F.col(x) for x in flows.columns if x != "client_id"])
    out = j.groupBy("client_id").agg(F.first(row).alias("_row"), *expense_exprs(bonuses, rates, p))
    return out.select("client_id", "_row.*", *[x for x in out.columns if x not in ("client_id", "_row")])


def report_b(
    attributes: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    countries: DataFrame,
    languages: DataFrame,
    tx: DataFrame,
    rates: DataFrame,
    days: DataFrame,
    balances: DataFrame,
    bonuses: DataFrame,
    p: ReportParams,
    flows: DataFrame | None = None,
    state: GamingState | None = None,
    latest: DataFrame | None = None,
) -> DataFrame:
    """The VIP customer report of job B (57 columns).

    Cohort: customers whose running base-currency deposits (valid rates)
    reached ``crossing_amount``. A customer with several balance rows on its
    latest day, or several attribute rows, appears once per row, as in the
    source, and its bonuses count once per attribute row.

    The transactions are read once (:mod:`customer360.operators.ledger`). The
    cohort enters the plan once, as the first frame of the join chain; every
    other source is aggregated per customer, map-side first, and meets it there.
    A job may compute the cohort's flows once, store them and pass them as
    ``flows``: then they also cut the raw inputs by semi joins, which cost no
    second computation (Spark broadcasts or shuffles them by their measured size).
    With ``state`` (``gaming_state``) the game days are not read, with ``latest``
    (``customers.merge_latest``) the balances are not.
    """
    if flows is None:
        flows = cohort_ledger(tx, rates, p)
    else:
        ids = flows.select("client_id")
        days, balances, bonuses, attributes = (t.join(ids, "client_id", "left_semi") for t in (days, balances, bonuses, attributes))
    gaming = gaming_b(days, p) if state is None else gaming_state.gaming_metrics(state, p, "last_bet_day", ggr_horizons=False)
    balance = latest_balance(balances) if latest is None else shown_balance(latest)
    times = attributes.groupBy("client_id").agg(F.count(F.lit(1)).alias("_times"))
    base = customer_dimension(attributes, customers, merchants, countries, languages, p).withColumnRenamed("customer_fk", "client_id")
    metrics = left_join_all(
        _with_bonuses(flows, bonuses, customers, rates, p), [times, gaming, balance], "client_id")
    metrics = metrics.withColumns(expense_columns(metrics, bonuses, p, F.col("_times")))
    wide = metrics.join(base, "client_id", "inner")
    email_text = decode_utf8("email") if dict(customers.dtypes).get("email") == "binary" else F.col("email")
    wide = kpi_ratios(wide, p).withColumns(
        {
            "customer_fk": F.col("client_id"),
            "days_since_last_bet": days_since(p.asof, "last_bet_date"),
            "is_blocked": blocked_flag(email_text),
        }
    )
    return wide.select(*[F.col(src).alias(label) for label, src in report_b_columns(p)])

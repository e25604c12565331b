"""Deposit / withdrawal flows: daily totals, horizon sums, running totals, VIP rules.

Input ``tx``: one row per money transaction with ``id, client_id, user_name,
txn_date`` (timestamp or date), ``status, txn_type, amount``.

Plan shape. Every customer-level result is one ``groupBy(client_id)`` whose
partial aggregation runs before the shuffle, so a customer holding a large
share of all rows is collapsed map-side instead of landing whole in one task.
Deposits and withdrawals come out of one scan and one shuffle
(:func:`flow_horizons`); the running totals shuffle per (customer, day)
aggregates only, so a window partition holds one row per calendar day.

Running counts are of distinct ids within a customer's login and day, while ids
hardly ever repeat. Zone maps show where they do: ids of a day are marked as bits
of 64-id zones, one aggregation on primitive buffers that folds runs of ids
before its shuffle (:func:`repeated_id_days`). Days without a repeated id are
counted; only the rows of the others are told apart by id.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from customer360.config import ReportParams
from customer360.functions.expressions import (
    days_since,
    money_sum,
    money_threshold,
    money_units,
    to_day,
    units_to_money,
)
from customer360.functions.money import Money, stored_eur

# Output column prefixes of the two flow kinds (source spelling kept).
DEPOSIT = "deposit"
WITHDRAWAL = "withdrawl"


def filter_approved(tx: DataFrame, p: ReportParams, txn_type=None) -> DataFrame:
    """Transactions with an approved status, optionally of one type.

    Both predicates are plain column comparisons, so they reach the scan as
    pushed filters.
    """
    cond = F.col("status").isin(*p.approved_statuses)
    if txn_type is not None:
        cond = cond & (F.col("txn_type") == F.lit(txn_type))
    return tx.filter(cond)


def daily_flow(tx: DataFrame, p: ReportParams, txn_type, prefix: str = "dpst", by_login: bool = True) -> DataFrame:
    """Approved transactions of one type per customer (, login) and day.

    Columns: keys, ``txn_date``, ``date_diff_<prefix>``, ``<prefix>_amt``
    (DOUBLE of the exact DECIMAL sum), ``<prefix>_cnt`` (count of ids).
    The day difference depends only on the day, so it is derived after the
    grouping instead of being a grouping key.
    """
    keys = ["client_id", "user_name"] if by_login else ["client_id"]
    return (
        filter_approved(tx, p, txn_type)
        .groupBy(*keys, to_day("txn_date").alias("txn_date"))
        .agg(money_sum("amount").alias(f"{prefix}_amt"), F.count("id").alias(f"{prefix}_cnt"))
        .withColumn(f"date_diff_{prefix}", days_since(p.asof, "txn_date"))
    )


def _kind_exprs(p: ReportParams, prefix: str, is_kind: Column, dd: Column, day_span: bool, amount: Money) -> list[Column]:
    """Aggregates of one flow kind over rows where ``is_kind`` holds.

    Rows of the other kind map to NULL and are ignored, so a customer without
    rows of this kind gets NULL in every column, exactly as if the kind had
    been aggregated on its own and left-joined.
    """
    out = [amount.or_zero(dd <= n).only(is_kind).total().double().alias(f"{prefix}_{n}_days") for n in p.horizons]
    out.append(amount.only(is_kind).total().double().alias(f"{prefix}_lifetime"))
    cnt_name = "total_deposits_count" if prefix == DEPOSIT else f"{prefix}_count"
    out.append(F.sum(F.when(is_kind, F.col("id").isNotNull().cast("bigint"))).alias(cnt_name))
    if day_span:
        out.append(F.min(F.when(is_kind, dd)).alias(f"days_since_last_{prefix}"))
        out.append(F.max(F.when(is_kind, dd)).alias(f"days_since_first_{prefix}"))
    return out


def flow_horizons(
    tx: DataFrame,
    p: ReportParams,
    kinds: Mapping[str, object] | None = None,
    day_span: Mapping[str, bool] | None = None,
    net: str | None = None,
    amount: Money | None = None,
) -> DataFrame:
    """Horizon sums, lifetime sum and count per customer for several flow kinds.

    ``kinds`` maps an output prefix to its ``txn_type`` (default deposits and
    withdrawals). One scan, one shuffle, whatever the number of kinds.
    Summing raw rows equals summing the per-day totals of the source query:
    a day inside the horizon contributes its amounts, one outside contributes
    0, and NULL amounts are skipped either way. ``net`` names an extra column,
    the exact difference of the two lifetime sums (NULL if either is missing).
    ``amount`` replaces the column of that name.
    """
    amount = Money((money_units("amount"),)) if amount is None else amount
    kinds = kinds or {DEPOSIT: p.deposit_type, WITHDRAWAL: p.withdrawal_type}
    day_span = day_span if day_span is not None else {DEPOSIT: True}
    dd = days_since(p.asof, "txn_date")
    base = filter_approved(tx, p).filter(F.col("txn_type").isin(*kinds.values()))
    exprs: list[Column] = []
    for prefix, t in kinds.items():
        exprs += _kind_exprs(p, prefix, F.col("txn_type") == F.lit(t), dd, day_span.get(prefix, False), amount)
    if net:
        plus, minus = (amount.only(F.col("txn_type") == F.lit(kinds[k])).total() for k in (DEPOSIT, WITHDRAWAL))
        exprs.append(plus.minus(minus).double().alias(net))
    return base.groupBy("client_id").agg(*exprs)


def deposit_horizons(tx: DataFrame, p: ReportParams) -> DataFrame:
    """Deposits: 6 horizon sums, lifetime, count, days since last / first deposit."""
    return flow_horizons(tx, p, {DEPOSIT: p.deposit_type})


def withdrawal_horizons(tx: DataFrame, p: ReportParams) -> DataFrame:
    """Withdrawals: 6 horizon sums, lifetime, count."""
    return flow_horizons(tx, p, {WITHDRAWAL: p.withdrawal_type}, day_span={})


def id_zones(rows: DataFrame) -> DataFrame:
    """Zone map of ``rows`` (``id, txn_date``): per day and zone of 64 ids, the rows
    with an id (``n``) and the distinct ids (``ids``). Ids that are not integers are
    zones of their own."""
    day = to_day("txn_date").alias("txn_date")
    some = rows.filter(F.col("id").isNotNull())
    if not isinstance(rows.schema["id"].dataType, IntegralType):
        return some.groupBy(day, F.col("id").alias("zone")).agg(F.count(F.lit(1)).alias("n"), F.lit(1).cast("bigint").alias("ids"))
    wide = F.col("id").cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), wide.bitwiseAND(F.lit(63)).cast("int"))
    return some.groupBy(day, F.shiftright(wide, 6).alias("zone")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_count(F.bit_or(bit)).cast("bigint").alias("ids"))


def repeated_id_days(rows: DataFrame) -> DataFrame:
    """``txn_date`` of the days on which an id occurs more than once."""
    return id_zones(rows).groupBy("txn_date").agg(F.sum("n").alias("n"), F.sum("ids").alias("ids")).filter("n > ids").select("txn_date")


def _with_repeats(rows: DataFrame, p: ReportParams, is_deposit: Column) -> DataFrame:
    """``rows`` plus ``_repeat``: (login, id) of a deposit on a day with repeated
    ids, NULL on all others, so that grouping by it too tells only those apart."""
    pair = F.struct("user_name", "id")
    if p.unique_txn_ids:
        return rows.withColumn("_repeat", F.when(F.lit(False), pair))
    days = repeated_id_days(rows.filter(is_deposit)).select(F.col("txn_date").alias("_day"), F.lit(True).alias("_again"))
    # At most one row per calendar day, so its size is bounded by the DATE type.
    marked = rows.join(F.broadcast(days), to_day("txn_date").eqNullSafe(F.col("_day")), "left")
    return marked.withColumn("_repeat", F.when(F.col("_again") & is_deposit & F.col("id").isNotNull(), pair)).drop("_day", "_again")


def _distinct_ids(count: str) -> Column:
    """Distinct ids of a group of :func:`_with_repeats`: its count, or the one it stands for."""
    return F.when(F.col("_repeat").isNotNull(), F.lit(1).cast("bigint")).otherwise(F.col(count))


def _up_to_day() -> WindowSpec:
    """The days of a customer up to the current one; a NULL day comes last, as job A's database sorts it."""
    w = Window.partitionBy("client_id").orderBy(F.col("txn_date").asc_nulls_last())
    return w.rangeBetween(Window.unboundedPreceding, Window.currentRow)


def cumulative_flow(tx: DataFrame, p: ReportParams, txn_type=None) -> DataFrame:
    """Per customer, login and day: amount, count and the running totals.

    The running frame is RANGE UNBOUNDED PRECEDING .. CURRENT ROW ordered by
    day only, so logins of one customer on the same day share one running
    total (peers), as in the source window; a NULL day comes last, as the
    source's database sorts it. The running count adds up the per-group
    distinct ids: on days with repeated ids the window sees a row per id, which
    are put together after it, on the same partitioning.
    """
    txn_type = p.deposit_type if txn_type is None else txn_type
    rows = _with_repeats(filter_approved(tx, p, txn_type), p, F.lit(True))
    daily = rows.groupBy("client_id", "user_name", to_day("txn_date").alias("txn_date"), "_repeat").agg(
        F.sum(money_units("amount")).alias("_amt"), F.count("id").alias("_cnt"))
    w = _up_to_day()
    run = daily.withColumns({"_run_amt": F.sum("_amt").over(w), "_run_cnt": F.sum(_distinct_ids("_cnt")).over(w)})
    out = run.groupBy("client_id", "user_name", "txn_date").agg(
        units_to_money(F.sum("_amt")).alias("dpst_amt"), F.sum("_cnt").alias("dpst_cnt"),
        units_to_money(F.max("_run_amt")).alias("cumulative_dpst_amt"), F.max("_run_cnt").alias("cumulative_dpst_count"))
    return out.select(
        "client_id", "user_name", "txn_date", days_since(p.asof, "txn_date").alias("date_diff_dpst"),
        "dpst_amt", "dpst_cnt", "cumulative_dpst_amt", "cumulative_dpst_count")


def _running_by_day(tx: DataFrame, p: ReportParams, txn_type) -> DataFrame:
    """Per customer and day (and repeated id): running amount and running distinct-id count.

    The per-login distinct counts of the source add up to the number of
    distinct (login, id) pairs.
    """
    rows = _with_repeats(filter_approved(tx, p, txn_type), p, F.lit(True))
    per_day = rows.groupBy("client_id", to_day("txn_date").alias("txn_date"), "_repeat").agg(
        F.sum(money_units("amount")).alias("_amt"), F.count("id").alias("_cnt"))
    w = _up_to_day()
    return per_day.select(
        "client_id", "txn_date", F.sum("_amt").over(w).alias("run_amt"), F.sum(_distinct_ids("_cnt")).over(w).alias("run_cnt"))


def qualification_date(tx: DataFrame, p: ReportParams, min_amount=None, min_count=None) -> DataFrame:
    """First day a customer's running deposits reach ``min_amount`` or ``min_count``."""
    min_amount = p.vip_min_amount if min_amount is None else min_amount
    min_count = p.vip_min_count if min_count is None else min_count
    run = _running_by_day(tx, p, p.deposit_type)
    return (
        run.filter((F.col("run_amt") >= money_threshold(min_amount)) | (F.col("run_cnt") >= F.lit(min_count)))
        .groupBy("client_id")
        .agg(F.min("txn_date").alias("vip_date"))
    )


def _day_rows(tx: DataFrame, p: ReportParams) -> DataFrame:
    """Totals of both flow kinds per customer, day and ``_repeat`` (see
    :func:`_with_repeats`), with ``_ids``, the distinct (login, id) deposit pairs."""
    units = money_units("amount")
    kinds = {DEPOSIT: p.deposit_type, WITHDRAWAL: p.withdrawal_type}
    day_aggs = []
    for prefix, t in kinds.items():
        is_kind = F.col("txn_type") == F.lit(t)
        day_aggs += [
            F.max(F.when(is_kind, F.lit(1))).alias(f"_{prefix}_any"),
            F.sum(F.when(is_kind, units)).alias(f"_{prefix}_units"),
            F.sum(F.when(is_kind, F.col("id").isNotNull().cast("bigint"))).alias(f"_{prefix}_cnt"),
        ]
    rows = filter_approved(tx, p).filter(F.col("txn_type").isin(*kinds.values()))
    rows = _with_repeats(rows, p, F.col("txn_type") == F.lit(p.deposit_type))
    out = rows.groupBy("client_id", to_day("txn_date").alias("txn_date"), "_repeat").agg(*day_aggs)
    return out.withColumn("_ids", _distinct_ids(f"_{DEPOSIT}_cnt"))


def flow_daily(tx: DataFrame, p: ReportParams) -> DataFrame:
    """Per (customer, day) totals of both flow kinds: the daily rollup.

    Columns: ``client_id, txn_date`` and per kind ``_<kind>_any`` (1 if the
    day has rows of the kind), ``_<kind>_units`` (exact sums),
    ``_<kind>_cnt`` (non-NULL ids), plus ``_ids`` (distinct (login, id)
    deposit pairs). Independent of the report date, so a daily job can keep it
    as a day-partitioned table and rebuild only the days that changed (see
    ``jobs.refresh_flow_rollup``): then only the ids of those days are looked at.
    """
    rows = _day_rows(tx, p)
    totals = [(F.max if c.endswith("_any") else F.sum)(c).alias(c) for c in rows.columns if c not in ("client_id", "txn_date", "_repeat")]
    return rows.groupBy("client_id", "txn_date").agg(*totals)


def day_total_exprs(p: ReportParams, amounts: Mapping[str, Money]) -> list[Column]:
    """Horizon sums, lifetime sum, count and (deposits) day span per customer, from
    rows of per-day totals (``_<kind>_any``, ``_<kind>_cnt`` and the kind's money).

    Horizon sums over day totals equal those over raw rows: a day inside the
    horizon adds its total, a day outside adds 0, and a kind with no rows
    stays NULL."""
    dd = days_since(p.asof, "txn_date")
    out = []
    for prefix, amount in amounts.items():
        present = F.col(f"_{prefix}_any").isNotNull()
        out += [amount.or_zero(dd <= n).only(present).total().double().alias(f"{prefix}_{n}_days") for n in p.horizons]
        out.append(amount.total().double().alias(f"{prefix}_lifetime"))
        cnt_name = "total_deposits_count" if prefix == DEPOSIT else f"{prefix}_count"
        out.append(F.sum(f"_{prefix}_cnt").alias(cnt_name))
        if prefix == DEPOSIT:
            out.append(F.min(F.when(present, dd)).alias(f"days_since_last_{prefix}"))
            out.append(F.max(F.when(present, dd)).alias(f"days_since_first_{prefix}"))
    return out


def flow_summary(tx: DataFrame, p: ReportParams, min_amount=None, min_count=None,
                 daily: DataFrame | None = None) -> DataFrame:
    """Deposit and withdrawal horizons plus the VIP qualification date, one scan.

    Equals ``flow_horizons(tx, p)`` left-joined with ``qualification_date``
    but reads the amounts once. The chain is: totals of each kind per (customer,
    day), partially aggregated; a running-total window per customer over
    those day rows; and a final per-customer aggregation on the window's
    partitioning (no further shuffle; :func:`day_total_exprs`). A second, narrow
    scan of ids and days makes the zone map; ``unique_txn_ids`` spares it. Pass
    ``daily`` (a stored rollup) to skip the transactions; ``tx`` is then unused.
    """
    min_amount = p.vip_min_amount if min_amount is None else min_amount
    min_count = p.vip_min_count if min_count is None else min_count
    kinds = {DEPOSIT: p.deposit_type, WITHDRAWAL: p.withdrawal_type}
    daily = _day_rows(tx, p) if daily is None else daily
    w = _up_to_day()
    run = daily.withColumns({"_run_amt": F.sum(f"_{DEPOSIT}_units").over(w), "_run_cnt": F.sum("_ids").over(w)})
    out = day_total_exprs(p, {k: Money((F.col(f"_{k}_units"),)) for k in kinds})
    qualifies = (F.col("_run_amt") >= money_threshold(min_amount)) | (F.col("_run_cnt") >= F.lit(min_count))
    out.append(F.min(F.when(qualifies, F.col("txn_date"))).alias("vip_date"))
    return run.groupBy("client_id").agg(*out)


def cohort_filter(min_amount, min_count) -> Column:
    """Lifetime VIP rule on a deposit-horizon frame."""
    return (F.col(f"{DEPOSIT}_lifetime") >= F.lit(min_amount)) | (F.col("total_deposits_count") >= F.lit(min_count))


def vip_cohort(tx: DataFrame, p: ReportParams, min_amount=None, min_count=None) -> DataFrame:
    """Customers whose lifetime deposits reach ``min_amount`` or ``min_count``, with their deposit metrics."""
    min_amount = p.vip_min_amount if min_amount is None else min_amount
    min_count = p.vip_min_count if min_count is None else min_count
    return deposit_horizons(tx, p).filter(cohort_filter(min_amount, min_count))


def net_deposits(tx_eur: DataFrame, p: ReportParams) -> DataFrame:
    """Total deposits and withdrawals (base currency) per customer, one pass.

    ``tx_eur`` comes from ``fx.fx_normalise``; each total is a conditional sum,
    the other type adds 0.
    """
    eur = stored_eur(tx_eur, p.fx_extra_digits)
    kinds = {"total_deposits": p.deposit_type, "total_withdrawals": p.withdrawal_type}
    return tx_eur.groupBy("client_id").agg(
        *[eur.or_zero(F.col("txn_type") == F.lit(t)).total().double().alias(name) for name, t in kinds.items()])

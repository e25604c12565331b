"""Adapters from the driver's TPC-H-style tables to the report's logical tables.

The report jobs read operator tables (customers, transactions, game-day
summaries, plays, balances, bonuses, dimensions, help-desk contacts). The test
data has none of them, so each is derived here from the driver tables with
plain DataFrame operations; FIXTURES.md gives the same definitions as SQL
(used verbatim by the DuckDB oracle). The derivations deliberately include
the traps of the real data: NULL / 'blocked' e-mails, two logins per
customer, pending and undated transactions, customers with two attribute rows, currencies without or with duplicate or zero
rates, zero bet counts, negative NGR, days after the report date.

Everything is lazy: an adapter is a plan over the parquet scans, so the
columns and filters a report uses are pushed into those scans.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from customer360.sources.tables import TableSet

# Fixed values of the test data mapping.
ASOF = dt.date(2001, 8, 1)
BIRTH_BASE = dt.date(1960, 1, 1)
CREATED_BASE = dt.date(1995, 1, 1)
EVENT_DAY_SHIFT = 8400  # moves the 2024 event days to early 2001
HIGH_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")
WINNING_EVENTS = ("purchase", "signup")


def _email(key: Column) -> Column:
    """NULL for key % 97 == 0, a 'blocked_' address for key % 50 == 0."""
    s = key.cast("string")
    return (
        F.when(key % 97 == 0, F.lit(None).cast("string"))
        .when(key % 50 == 0, F.concat(F.lit("blocked_"), s, F.lit("@example.test")))
        .otherwise(F.concat(F.lit("u"), s, F.lit("@example.test")))
    )


def _money(c: str, precision: int = 12) -> Column:
    return F.col(c).cast(f"decimal({precision},2)")


def _shifted_day(c: str) -> Column:
    return F.date_sub(F.to_date(F.col(c)), EVENT_DAY_SHIFT)


def _memo(method):
    """Build an adapter's plan once per Fixtures instance."""
    name = method.__name__

    def wrapper(self):
        if name not in self._plans:
            self._plans[name] = method(self)
        return self._plans[name]

    wrapper.__name__ = name
    wrapper.__doc__ = method.__doc__
    return wrapper


class Fixtures:
    """The logical report tables over one test-data directory.

    ``Fixtures.shared(spark, dir)`` reuses one instance (and its plans) per
    session and directory.
    """

    _shared: dict[tuple, "Fixtures"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = TableSet.shared(spark, sf_dir)
        self._plans: dict[str, DataFrame] = {}

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Fixtures":
        key = (id(spark), sf_dir.rstrip("/"))
        f = cls._shared.get(key)
        if f is None or f.spark is not spark:
            f = cls._shared[key] = cls(spark, sf_dir)
        return f

    # -- customers and dimensions -------------------------------------------
    @_memo
    def customers(self) -> DataFrame:
        c, n = self.t.customer, self.t.nation
        k = F.col("c_custkey")
        return c.join(n, c.c_nationkey == n.n_nationkey).select(
            k.alias("id"),
            _email(k).alias("email"),
            F.col("c_name").alias("login"),
            F.concat(F.lit("F"), (k % 40).cast("string")).alias("first_name"),
            F.concat(F.lit("L"), (k % 60).cast("string")).alias("last_name"),
            (F.lit(900000000) + k).cast("string").alias("mobile_number"),
            F.col("n_name").alias("country_name"),
            F.col("n_regionkey").alias("language_fk"),
            F.date_add(F.lit(BIRTH_BASE), (k % 12000).cast("int")).alias("birth_date"),
            (k % 25).alias("affiliate_id"),
            (k % 4).alias("partner_id"),
            F.concat(F.lit("S"), (k % 50).cast("string")).alias("state_name"),
            F.col("c_nationkey").alias("country_fk"),
            (k % 500).alias("merchant_fk"),
            (k % 30).alias("currency_fk"),
            F.date_add(F.lit(CREATED_BASE), (k % 365).cast("int")).alias("created_on"),
            F.when(k % 13 == 0, F.lit(None).cast("date"))
            .otherwise(F.date_sub(F.lit(ASOF), (k % 120).cast("int")))
            .alias("last_session_on"),
        )

    @_memo
    def attributes(self) -> DataFrame:
        """One row per customer, and a second one for every 53rd."""
        k = F.col("c_custkey")
        one = self.t.customer.select(
            k.alias("client_id"),
            F.col("c_mktsegment").alias("referral_info"),
            F.date_add(F.lit(CREATED_BASE), (k % 365).cast("int")).alias("registered_on"),
        )
        return one.unionByName(one.filter(F.col("client_id") % 53 == 0).withColumn("referral_info", F.lit("second")))

    @_memo
    def merchants(self) -> DataFrame:
        return self.t.supplier.select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
        )

    @_memo
    def countries(self) -> DataFrame:
        return self.t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("country_desc"))

    @_memo
    def languages(self) -> DataFrame:
        return self.t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("lang_desc"))

    @_memo
    def bonus_defs(self) -> DataFrame:
        return self.t.part.select(
            F.col("p_partkey").alias("id"),
            F.col("p_brand").alias("promo_code"),
            F.col("p_name").alias("description"),
        )

    @_memo
    def currencies(self) -> DataFrame:
        """Rates per currency id; id 3 twice (one invalid), id 7 rate 0."""
        n = self.t.nation
        k = F.col("n_nationkey")
        rate_t = "decimal(10,3)"
        main = n.select(
            k.cast("bigint").alias("id"),
            F.when(k == 7, F.lit(0)).otherwise(F.lit(0.5) + k * F.lit(0.125)).cast(rate_t).alias("rate_to_eur"),
            F.when(k % 5 == 0, F.lit(0)).otherwise(F.lit(1)).alias("is_valid"),
        )
        extra = n.filter(k == 3).select(
            k.cast("bigint").alias("id"), F.lit(4.0).cast(rate_t).alias("rate_to_eur"), F.lit(0).alias("is_valid")
        )
        return main.unionByName(extra)

    # -- facts ----------------------------------------------------------------
    @_memo
    def transactions(self) -> DataFrame:
        o = self.t.orders
        key = F.col("o_orderkey")
        return o.select(
            key.alias("id"),
            F.col("o_custkey").alias("client_id"),
            F.concat(F.lit("login"), (key % 2).cast("string")).alias("user_name"),
            F.when(key % 89 != 0, F.to_date("o_orderdate")).alias("txn_date"),
            F.when(F.col("o_orderstatus") == "F", "Approved")
            .when(F.col("o_orderstatus") == "P", "ApprovedManually")
            .otherwise("Pending")
            .alias("status"),
            F.when(F.col("o_orderpriority").isin(*HIGH_PRIORITIES), F.lit(2)).otherwise(F.lit(1)).alias("txn_type"),
            (F.col("o_custkey") % 30).alias("currency_fk"),
            _money("o_totalprice", 18).alias("amount"),
        )

    def _line_orders(self) -> DataFrame:
        li = self.t.lineitem
        o = self.t.orders.select("o_orderkey", "o_custkey")
        return li.join(o, li.l_orderkey == o.o_orderkey)

    @_memo
    def game_days(self) -> DataFrame:
        price = _money("l_extendedprice")
        return self._line_orders().select(
            F.col("o_custkey").alias("client_id"),
            F.to_date("l_shipdate").alias("summary_day"),
            price.alias("bet_amount"),
            F.when(F.col("l_linenumber") == 1, F.lit(0).cast("bigint"))
            .otherwise(F.col("l_quantity").cast("bigint"))
            .alias("bets_count"),
            (price * F.col("l_discount").cast("decimal(4,2)")).alias("ggr"),
            (price * (F.col("l_discount") - F.col("l_tax")).cast("decimal(4,2)")).alias("ngr"),
            (price * (F.lit(1) - F.col("l_discount")).cast("decimal(4,2)")).alias("returns_amount"),
        )

    @_memo
    def game_plays(self) -> DataFrame:
        p = self.t.part.select("p_partkey", "p_brand", "p_name")
        lo = self._line_orders()
        return lo.join(p, lo.l_partkey == p.p_partkey).select(
            F.col("o_custkey").alias("client_id"),
            F.col("p_brand").alias("provider_name"),
            F.col("p_name").alias("product_name"),
            F.col("l_quantity").cast("bigint").alias("played_count"),
            F.to_date("l_shipdate").alias("summary_day"),
        )

    @_memo
    def balances(self) -> DataFrame:
        e = self.t.events
        return e.groupBy(F.col("user_id").alias("client_id"), _shifted_day("ts").alias("summary_day")).agg(
            F.sum(_money("value")).cast("decimal(18,2)").alias("balance")
        )

    @_memo
    def bonuses(self) -> DataFrame:
        e = self.t.events
        return e.select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("client_id"),
            (F.col("event_id") % 9001).alias("bonus_fk"),
            (F.col("user_id") % 500).alias("merchant_fk"),
            _shifted_day("ts").alias("bonus_date"),
            F.when(F.col("event_type").isin(*WINNING_EVENTS), "WIN").otherwise("LOST").alias("status"),
            F.when(F.col("event_type") == "signup", F.lit(0).cast("decimal(12,2)"))
            .otherwise(_money("value"))
            .alias("winning_amount"),
        )

    @_memo
    def last_contacts(self) -> DataFrame:
        cv = self.t.conversations
        return cv.groupBy("conv_id").agg(F.max("turn").alias("last_contact_turn")).select(
            _email(F.col("conv_id")).alias("requester_email"), "last_contact_turn"
        )

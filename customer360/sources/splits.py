"""Database reads split by the data's own quantiles, and continued where the last one ended.

Equal strides between a key's bounds make equal reads only if keys are spread
evenly, and exist only for numbers and dates. Here the database is asked, in one
query, for the keys at which equal shares of rows begin; every share becomes
a predicate that one task reads. Keys may be numbers, texts, dates or
timestamps. Where one key value holds more than a share, a second column (``then``,
a unique id, say) goes on dividing inside it: cuts are pairs in the order of
both columns.

A read may begin after a stored high-water mark. The mark that a read ends at is
found by the same query, before any row is read, and bounds the read, so rows that
arrive meanwhile are left to the next one; it is stored when the caller commits.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from customer360.sources.versions import Versions


def sql_literal(value) -> str:
    """A value as a literal that every JDBC driver reads (escape syntax for times)."""
    if isinstance(value, bool) or value is None:
        raise ValueError(f"no split key: {value!r}")
    if isinstance(value, (int, float, decimal.Decimal)):
        return format(value, "f") if isinstance(value, decimal.Decimal) else repr(value)
    if isinstance(value, dt.datetime):
        return "{ts '" + value.strftime("%Y-%m-%d %H:%M:%S.%f") + "'}"
    if isinstance(value, dt.date):
        return "{d '" + value.isoformat() + "'}"
    return "'" + str(value).replace("'", "''") + "'"


@dataclass(frozen=True)
class Splits:
    """Predicates that together select every wanted row once, and the largest key among them."""

    predicates: list[str]
    top: object = None
    cuts: list[tuple] = field(default_factory=list)


def _ordered(table: str, key: str, then: str | None, where: str, url: str) -> str:
    """Rows numbered in the order of the key(s)."""
    columns = f"{key} AS k" + (f", {then} AS t" if then else "")
    order = f"{key}, {then}" if then else key
    if url.startswith("jdbc:derby"):  # numbers rows in the order they come
        names = "k, t" if then else "k"
        return f"SELECT {names}, ROW_NUMBER() OVER () AS rn FROM (SELECT {columns} FROM {table} WHERE {where} ORDER BY {order}) o"
    return f"SELECT {columns}, ROW_NUMBER() OVER (ORDER BY {order}) AS rn FROM {table} WHERE {where}"


def cuts_query(table: str, key: str, shares: int, url: str, then: str | None = None, where: str | None = None) -> str:
    """The key(s) at which each of ``shares`` equal shares begins (``part`` 0), and the largest key (``part`` 1)."""
    where = f"{key} IS NOT NULL" + (f" AND ({where})" if where else "")
    t, none = (", q.t AS t", f", MAX({then}) AS t") if then else ("", "")
    # The share number floor((rn - 1) * shares / rows) grows where the remainder is below shares.
    return (f"SELECT 0 AS part, q.k AS k{t} FROM ({_ordered(table, key, then, where, url)}) q "
            f"WHERE MOD((q.rn - 1) * {shares}, (SELECT COUNT(*) FROM {table} WHERE {where})) < {shares} "
            f"UNION ALL SELECT 1 AS part, MAX({key}) AS k{none} FROM {table} WHERE {where}")


def _at_least(key: str, then: str | None, cut: tuple) -> str:
    k = sql_literal(cut[0])
    if then is None:
        return f"{key} >= {k}"
    return f"({key} > {k} OR ({key} = {k} AND {then} >= {sql_literal(cut[1])}))"


def _below(key: str, then: str | None, cut: tuple) -> str:
    k = sql_literal(cut[0])
    if then is None:
        return f"{key} < {k}"
    return f"({key} < {k} OR ({key} = {k} AND {then} < {sql_literal(cut[1])}))"


def plan_splits(spark: SparkSession, url: str, table: str, key: str, shares: int, options: Mapping[str, str] | None = None,
                then: str | None = None, after=None) -> Splits:
    """Ask the database where ``shares`` equal reads of ``table`` begin (rows whose
    ``key`` is above ``after`` only, if given). ``then`` must not be NULL; rows with a
    NULL key are a read of their own, unless ``after`` is given."""
    where = f"{key} > {sql_literal(after)}" if after is not None else None
    found = spark.read.format("jdbc").option("url", url).option("query", cuts_query(table, key, shares, url, then, where))
    # One row a share, and one for the largest key.
    rows = [{c.lower(): v for c, v in r.asDict().items()} for r in found.options(**dict(options or {})).load().toLocalIterator()]
    cuts = sorted({(r["k"], r["t"]) if then else (r["k"],) for r in rows if r["part"] == 0})
    top = next((r["k"] for r in rows if r["part"] == 1), None)
    bound = [] if top is None else [f"{key} <= {sql_literal(top)}"]
    out = []
    for i, cut in enumerate(cuts):
        low = [_at_least(key, then, cut)] if i else [where] if where else [f"{key} IS NOT NULL"]
        out.append(" AND ".join(low + ([_below(key, then, cuts[i + 1])] if i + 1 < len(cuts) else bound)))
    if after is None:
        out.append(f"{key} IS NULL")
    return Splits(out, top, cuts)


class HighWater:
    """The largest key that has been read of a table, stored under ``path``."""

    SCHEMA = T.StructType([T.StructField("kind", T.StringType()), T.StructField("value", T.StringType())])
    READ = {"int": int, "float": float, "Decimal": decimal.Decimal, "str": str, "date": dt.date.fromisoformat, "datetime": dt.datetime.fromisoformat}

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self._store = spark, Versions(spark, path)

    def value(self):
        """The stored key, None before the first commit."""
        stored = self._store.read(self.SCHEMA)
        row = stored.first() if stored is not None else None
        return None if row is None else self.READ[row["kind"]](row["value"])

    def commit(self, top) -> None:
        """Store ``top``; call it once the rows up to it are safe. None (no rows) changes nothing."""
        if top is not None:
            text = top.isoformat() if isinstance(top, dt.date) else str(top)
            self._store.write(self.spark.createDataFrame([(type(top).__name__, text)], self.SCHEMA).coalesce(1))


def read_split(spark: SparkSession, url: str, table: str, key: str, shares: int, options: Mapping[str, str] | None = None,
               then: str | None = None, after=None) -> tuple[DataFrame, object]:
    """``table`` read by tasks of equal shares (see :func:`plan_splits`), and the
    largest key in it (``after`` again if there is no row)."""
    splits = plan_splits(spark, url, table, key, shares, options, then, after)
    predicates = splits.predicates or ["1 = 0"]
    df = spark.read.jdbc(url, table, predicates=predicates, properties=dict(options or {}))
    return df, after if splits.top is None else splits.top


def read_new(spark: SparkSession, url: str, table: str, key: str, shares: int, path: str,
             options: Mapping[str, str] | None = None, then: str | None = None) -> tuple[DataFrame, "callable"]:
    """The rows of ``table`` that came after the mark stored under ``path`` (all at
    first), and a function that stores the new mark once they are safe."""
    mark = HighWater(spark, path)
    df, top = read_split(spark, url, table, key, shares, options, then, mark.value())
    return df, lambda: mark.commit(top)

"""Scalar and aggregate expression builders shared by the operators.

Conventions (kept identical in the SQL oracle so results hash equal):

* money is summed as DECIMAL at its declared scale (exact and independent of
  order), and exposed as DOUBLE;
* ratios cast both operands to DOUBLE and divide with ``try_divide`` so a
  zero or NULL denominator yields NULL (Spark 4 ANSI ``/`` raises instead);
* day differences are ``datediff(asof, day)`` (INT).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_date(asof) -> Column:
    if isinstance(asof, Column):
        return asof
    if isinstance(asof, str):
        return F.to_date(F.lit(asof))
    if isinstance(asof, dt.datetime):
        return F.lit(asof.date())
    return F.lit(asof)


def to_day(c) -> Column:
    """Timestamp (or date) to calendar day."""
    return F.to_date(_col(c))


def days_since(asof, c) -> Column:
    """Whole days from ``c`` to ``asof`` (negative for future days, NULL for NULL)."""
    return F.datediff(_lit_date(asof), to_day(c))


def within(date_diff, n: int) -> Column:
    """Horizon predicate: inclusive, future rows pass, NULL day is false."""
    return _col(date_diff) <= F.lit(n)


def on_or_after(day_col, asof, n: int) -> Column:
    """The horizon filter ``datediff(asof, day) <= n`` in push-down form.

    ``day >= asof - n`` selects the same rows (inclusive, future days pass,
    NULL fails) for a DATE column, and for a timestamp column the day bound
    is midnight; as a plain comparison on the column it reaches the parquet
    scan (row groups and files entirely before the bound are skipped).
    """
    if isinstance(asof, (dt.date, dt.datetime)):
        bound = F.lit((asof.date() if isinstance(asof, dt.datetime) else asof) - dt.timedelta(days=n))
    else:
        bound = F.date_sub(_lit_date(asof), n)
    return _col(day_col) >= bound


def money_units(c) -> Column:
    """Money as it is added up: the column itself. A DECIMAL sum is exact at the
    column's declared scale, whatever it is, and independent of row order; a
    DOUBLE column has no declared scale and is added up as DOUBLE."""
    return _col(c)


def units_to_money(units: Column) -> Column:
    """A money sum as the DOUBLE amount that the reports show."""
    return units.cast("double")


def money_threshold(amount) -> Column:
    """A money threshold, for exact comparisons with DECIMAL sums."""
    return F.lit(Decimal(str(amount)))


def horizon_money(date_diff, value, n: int, units: Column | None = None) -> Column:
    """``horizon_sum`` of a DECIMAL money column, exact, as DOUBLE.

    Pass ``units`` (``money_units(value)``) when building several horizons of
    one column, so the conversion expression is built once.
    """
    u = money_units(value) if units is None else units
    return units_to_money(F.sum(F.when(within(date_diff, n), u).otherwise(F.lit(0))))


def horizon_sum(date_diff, value, n: int) -> Column:
    """``sum(case when date_diff <= n then value else 0 end)``.

    Rows outside the horizon contribute a non-NULL zero, so the result is 0
    (not NULL) for a customer with rows but none inside the horizon.
    """
    # The INT zero widens to the value's type (DECIMAL/BIGINT/DOUBLE).
    return F.sum(F.when(within(date_diff, n), _col(value)).otherwise(F.lit(0)))


def present_in(date_diff, n: int) -> Column:
    """1 if any row falls in the horizon, else NULL (used as a presence flag)."""
    return F.max(F.when(within(date_diff, n), F.lit(1)))


def money_sum(value) -> Column:
    """Exact sum of a DECIMAL money column, exposed as DOUBLE (NULL if no values)."""
    return units_to_money(F.sum(money_units(value)))


def ratio(num, den) -> Column:
    """``num / den`` in DOUBLE; NULL when ``den`` is 0 or either side is NULL."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))

"""Presentation expressions: money text, rounding, decoding, report dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from customer360.functions.expressions import _col, _lit_date

# Fixed values of the EUR / nl-NL currency text: the euro sign, a no-break
# space, '.' as thousands separator, ',' as decimal separator, two decimals,
# and the minus sign after the currency sign ("€ -1.234,00").
EURO_SIGN = "€"
NO_BREAK_SPACE = " "
# Report label date: the day before the run date, month-day-year.
REPORT_DATE_FORMAT = "MM-dd-yyyy"


def whole_units(c) -> Column:
    """NULL/NaN -> 0, then truncate toward zero to a whole number (BIGINT).

    ``nanvl`` matters: under ANSI, casting NaN to BIGINT raises.
    """
    v = F.nanvl(F.coalesce(_col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.when(v >= 0, F.floor(v)).otherwise(F.ceil(v)).cast("bigint")


def eur_text(c) -> Column:
    """Whole-euro amount as nl-NL currency text, e.g. ``€ 1.234.567,00``.

    NULL becomes ``€ 0,00`` (the source fills NULL with 0 before formatting).
    """
    n = whole_units(c)
    grouped = F.translate(F.format_number(n, 2), ",.", ".,")
    return F.concat(F.lit(EURO_SIGN + NO_BREAK_SPACE), grouped)


def round2(c, digits: int = 2) -> Column:
    """Round a DOUBLE to ``digits`` places as the source's data frames do.

    They hold 64-bit floats, whose rounding scales by a power of ten, rounds to
    the nearest whole number (ties to even) and scales back: 40153.575 ->
    40153.57, 1142.785 -> 1142.79, 2.345 -> 2.35.
    """
    power = float(10**digits)
    return F.rint(_col(c).cast("double") * power) / power


def decode_utf8(c) -> Column:
    """Bytes to text (UTF-8)."""
    return F.decode(_col(c), "UTF-8")


def blocked_flag(c, marker: str = "blocked") -> Column:
    """1 if the (case-sensitive) text contains ``marker``, else 0; NULL -> 0."""
    return F.when(_col(c).contains(marker), F.lit(1)).otherwise(F.lit(0))


def report_date(asof) -> Column:
    """The day before ``asof`` as ``MM-dd-yyyy`` text."""
    return F.date_format(F.date_sub(_lit_date(asof), 1), REPORT_DATE_FORMAT)

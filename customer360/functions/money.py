"""Money expressions that stay exact whatever the declared precision.

Most money columns leave room in a DECIMAL(38): their sums, quotients and
products with counts are single columns. A wide column (for example DECIMAL(38,18),
as a database's numeric without a declared scale arrives) does not; its
base-currency amounts are carried as two limbs: the whole part (floor) and the
fraction in units of ``10**-scale``, both DECIMAL(38,0). Sums, products with
counts and comparisons work limb by limb; carries are settled only when a value
is compared or shown. Which form is used follows from the column types alone.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

#: Digits of a single-column quotient; ten more are left for its sums.
NARROW_DIGITS = 28
_INT = "decimal(38,0)"


def _int(n: int) -> Column:
    return F.lit(Decimal(n))


def _quotient(x: Column, y: Column) -> tuple[Column, Column]:
    """Quotient and remainder of non-negative integers (DECIMAL(38,0)); of at
    most 32 digits, as the type of a DECIMAL division has it."""
    rest = (x % y).cast(_INT)
    return ((x - rest).cast(_INT) / y).cast(_INT), rest


def _split(value: Column, scale: int) -> tuple[Column, Column]:
    """Whole part and fraction (in units of ``10**-scale``) of a non-negative
    DECIMAL, as integers. ``%`` keeps all digits, where a difference may not."""
    whole = F.floor(value).cast(_INT)
    if scale == 0:
        return whole, _int(0).cast(_INT)
    half = scale // 2
    # Shifted in two steps, so that no intermediate type runs out of digits.
    part = (value % _int(1)).cast(f"decimal({min(38, scale + 1)},{scale})")
    shifted = (part * _int(10**half).cast(f"decimal({half + 1},0)")).cast(f"decimal({scale},{scale - half})")
    low = (shifted % _int(1)).cast(f"decimal({scale - half + 1},{scale - half})")
    low = (low * _int(10 ** (scale - half)).cast(f"decimal({scale - half + 1},0)")).cast(_INT)
    return whole, (F.floor(shifted).cast(_INT) * _int(10 ** (scale - half)) + low).cast(_INT)


class Money:
    """A money expression: ``(value,)``, or ``(whole, part)`` with the scale of part."""

    def __init__(self, limbs: tuple[Column, ...], scale: int = 0):
        self.limbs, self.scale = limbs, scale

    @classmethod
    def column(cls, name: str, frame_columns: list[str], scale: int = 0) -> "Money":
        """The money stored as ``name`` (and ``name_part``) by :meth:`named`."""
        part = f"{name}_part"
        return cls((F.col(name), F.col(part)), scale) if part in frame_columns else cls((F.col(name),))

    def named(self, name: str) -> dict[str, Column]:
        return dict(zip((name, f"{name}_part"), self.limbs))

    def _map(self, f) -> "Money":
        return Money(tuple(f(x) for x in self.limbs), self.scale)

    def only(self, condition: Column) -> "Money":
        """NULL where the condition does not hold."""
        return self._map(lambda x: F.when(condition, x))

    def or_zero(self, condition: Column) -> "Money":
        """Zero where the condition does not hold."""
        return self._map(lambda x: F.when(condition, x).otherwise(F.lit(0)))

    def total(self, over: WindowSpec | None = None) -> "Money":
        return self._map(lambda x: F.sum(x) if over is None else F.sum(x).over(over))

    def minus(self, other: "Money") -> "Money":
        return Money(tuple(a - b for a, b in zip(self.limbs, other.limbs, strict=True)), self.scale)

    def times(self, n: Column, scale: int | None = None) -> "Money":
        """The product with a count. A single column of more than six digits after
        the point (``scale``) is split first: a product with a wide count would
        be rounded to six."""
        n = n.cast("decimal(20,0)")
        if len(self.limbs) == 2:
            return self._map(lambda x: (x * n).cast(_INT))
        if scale is None or scale <= 6:
            return self._map(lambda x: x * n)
        whole = F.floor(self.limbs[0]).cast(_INT)
        rest = self.limbs[0] % _int(1)  # has the sign of the value
        _, part = _split(F.when(rest < 0, rest + _int(1)).otherwise(rest).cast(f"decimal({scale + 1},{scale})"), scale)
        return Money((whole, part), scale).times(n)

    def _settled(self) -> tuple[Column, Column]:
        """Whole and part with 0 <= part < 10**scale."""
        whole, part = self.limbs
        unit = _int(10**self.scale)
        rest = (part % unit).cast(_INT)
        rest = F.when(rest < 0, rest + unit).otherwise(rest).cast(_INT)
        return (whole + ((part - rest).cast(_INT) / unit).cast(_INT)).cast(_INT), rest

    def at_least(self, amount) -> Column:
        """``self >= amount`` (a number)."""
        amount = Decimal(str(amount))
        if len(self.limbs) == 1:
            return self.limbs[0] >= F.lit(amount)
        whole, part = self._settled()
        low = int(amount // 1) - (amount < 0 and amount % 1 != 0)
        # The smallest part that reaches the amount.
        need = -int(-((amount - low) * 10**self.scale) // 1)
        return (whole > _int(low)) | ((whole == _int(low)) & (part >= _int(need)))

    def positive(self) -> Column:
        if len(self.limbs) == 1:
            return self.limbs[0] > 0
        whole, part = self._settled()
        return (whole > 0) | ((whole == 0) & (part > 0))

    def double(self) -> Column:
        """The nearest DOUBLE."""
        if len(self.limbs) == 1:
            return self.limbs[0].cast("double")
        whole, part = self._settled()
        below = (whole < 0) & (part > 0)
        digits = F.lpad(F.when(below, _int(10**self.scale) - part).otherwise(part).cast(_INT).cast("string"), self.scale, "0")
        before = F.when(below, F.concat(F.lit("-"), (-whole - 1).cast(_INT).cast("string"))).otherwise(whole.cast("string"))
        return F.concat(before, F.lit("."), digits).cast("double") if self.scale else whole.cast("double")


def divided(amount: Column, kind: DataType, rate: Column, rate_kind: DataType, extra: int) -> Money:
    """``amount / rate``; NULL if either is NULL or the rate is 0.

    The quotient of DECIMALs has ``extra`` digits more than the amount's scale, rounded half
    away from zero, as the source database's decimal division gives. One column
    where its type has room for it and its sums; otherwise a long division into
    two limbs. Anything else is divided in DOUBLE."""
    if not isinstance(kind, DecimalType):
        return Money((F.try_divide(amount, rate).cast("double"),))
    scale = kind.scale + extra
    rate_scale = rate_kind.scale if isinstance(rate_kind, DecimalType) else 3
    if kind.precision + rate_scale + extra <= NARROW_DIGITS or not isinstance(rate_kind, DecimalType):
        return Money((F.try_divide(amount, rate).cast(f"decimal({NARROW_DIGITS},{scale})"),))
    usable = F.when(rate != 0, rate)
    whole, part = _split(F.abs(amount), kind.scale)
    rw, rp = _split(F.abs(usable), rate_scale)
    divisor = (rw * _int(10**rate_scale) + rp).cast(_INT)
    # A remainder stays below the divisor; chunks of digits are taken down while
    # both together fit. Rates of more than 30 digits in all have no room.
    room = max(8, 38 - max(rate_kind.precision, 1))
    q, rest = _quotient(whole, divisor)
    total = kind.scale + rate_scale + extra
    edges = sorted({0, rate_scale, kind.scale, total} | set(range(0, total, room)))
    digits_whole, digits_part = q, _int(0).cast(_INT)
    for a, z in zip(edges[:-1], edges[1:], strict=True):
        n = z - a
        down = _int(0)
        if z <= kind.scale:
            shifted = (part - part % _int(10 ** (kind.scale - z))).cast(_INT) / _int(10 ** (kind.scale - z))
            down = shifted.cast(_INT) % _int(10**n)
        q, rest = _quotient((rest * _int(10**n) + down).cast(_INT), divisor)
        if z <= rate_scale:
            digits_whole = (digits_whole * _int(10**n) + q).cast(_INT)
        else:
            digits_part = (digits_part * _int(10**n) + q).cast(_INT)
    digits_part = (digits_part + F.when(rest * 2 >= divisor, _int(1)).otherwise(_int(0))).cast(_INT)
    # Below zero, floor and fraction of the negated value.
    negative = (amount < 0) != (usable < 0)
    some = negative & (digits_part > 0)
    unit = _int(10**scale)
    w = F.when(some, -digits_whole - 1).when(negative, -digits_whole).otherwise(digits_whole).cast(_INT)
    f = F.when(some, unit - digits_part).otherwise(digits_part).cast(_INT)
    return Money((w, f), scale)


def stored_eur(frame: DataFrame, extra: int) -> Money:
    """The base-currency amounts of ``frame`` (column ``amount``) that were stored as ``amount_eur``."""
    kind = frame.schema["amount"].dataType
    return Money.column("amount_eur", frame.columns, kind.scale + extra if isinstance(kind, DecimalType) else 0)

"""Two-limb money against Python's Decimal: quotients, sums, products, comparisons."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal, localcontext
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from customer360.functions.money import Money, divided

D = Decimal


def quotient(a, r, places):
    """a / r with so many places, half away from zero; None for a zero or missing operand."""
    if a is None or not r:
        return None
    with localcontext() as c:
        c.prec = 120
        q = Fraction(a) / Fraction(r) * 10**places
        n, rest = divmod(abs(q.numerator), q.denominator)
        n += 2 * rest >= q.denominator
        return D(n if q >= 0 else -n).scaleb(-places)


def value(whole, part, scale):
    with localcontext() as c:
        c.prec = 120
        return None if whole is None else D(whole) + D(part).scaleb(-scale)


def amounts(kind, rng, n):
    top = 10 ** (kind.precision - kind.scale)
    out = [None, D(0), D(1), D(-1)] + [D("0.5"), D("-0.5")] * (kind.scale > 0)
    for _ in range(n):
        with localcontext() as c:
            c.prec = 60
            x = D(rng.randrange(min(top, 10**rng.randrange(1, 17)))) + D(rng.randrange(10**kind.scale)).scaleb(-kind.scale)
            out.append(-x if rng.random() < 0.3 else x)
    return out


KINDS = [(DecimalType(38, 18), DecimalType(10, 3)), (DecimalType(38, 18), DecimalType(38, 18)), (DecimalType(30, 2), DecimalType(10, 3)),
         (DecimalType(38, 0), DecimalType(12, 6)), (DecimalType(25, 9), DecimalType(10, 0)), (DecimalType(38, 18), DecimalType(20, 10))]


@pytest.mark.parametrize("kind, rate_kind", KINDS)
def test_wide_quotients_sums_and_comparisons(spark, kind, rate_kind):
    rng = random.Random(kind.scale * 100 + rate_kind.scale)
    step = D(1).scaleb(-min(6, rate_kind.scale))  # rates of money, not of atoms
    rates = [None, D(0), D(1), step * 7, D(3), D(-2), D("1000") + step, step * 123, D(8) + 5 * step]
    data = [(i % 5, a, r) for i, (a, r) in enumerate((a, r) for a in amounts(kind, rng, 12) for r in rates)]
    df = spark.createDataFrame(data, f"k int, a {kind.simpleString()}, r {rate_kind.simpleString()}").repartition(4)
    m = divided(F.col("a"), kind, F.col("r"), rate_kind, 4)
    scale = kind.scale + 4
    assert m.scale == scale and len(m.limbs) == 2
    stored = df.withColumns(m.named("q"))
    one = Money.column("q", stored.columns, scale)
    got = stored.select("a", "r", "q", "q_part", one.double().alias("d"), one.positive().alias("pos"), one.at_least("0.75").alias("at"), one.at_least("-2.5").alias("below")).collect()
    for r in got:
        want = quotient(r["a"], r["r"], scale)
        assert value(r["q"], r["q_part"], scale) == want, (r["a"], r["r"])
        assert r["d"] == (None if want is None else float(want))
        assert want is None or (r["pos"], r["at"], r["below"]) == (want > 0, want >= D("0.75"), want >= D("-2.5"))
        assert want is None or 0 <= r["q_part"] < 10**scale
    sums = defaultdict(lambda: [D(0), D(0), None])
    with localcontext() as c:
        c.prec = 120
        for k, a, r in data:
            q = quotient(a, r, scale)
            if q is not None:
                sums[k][0] += q
                sums[k][1] += q * 3_000_000_007
                sums[k][2] = q if sums[k][2] is None else sums[k][2] + (q if q > 0 else 0)
        n = F.lit(3_000_000_007)
        out = stored.groupBy("k").agg(one.total().double().alias("s"), one.times(n).total().double().alias("p"), one.total().at_least(12345).alias("at"),
                                      one.total().minus(one.total()).double().alias("z"), one.or_zero(F.col("a") > 0).total().double().alias("o"))
        for r in out.collect():
            s, p, _ = sums[r["k"]]
            assert (r["s"], r["p"], r["at"], r["z"]) == (float(s), float(p), s >= 12345, 0.0)


def test_a_million_and_a_half_of_a_wide_currency(spark):
    """The amount at which a DECIMAL(28, scale + 4) cast ended the job."""
    kind = DecimalType(38, 18)
    df = spark.createDataFrame([(D("1500000"),), (D("1000000000000.000000000000000001"),)], "a decimal(38,18)")
    m = divided(F.col("a"), kind, F.lit(D("0.001")).cast("decimal(10,3)"), DecimalType(10, 3), 4)
    total = df.select(m.total().double().alias("t"), *[x.alias(n) for n, x in m.total().named("w").items()]).first()
    assert value(total["w"], total["w_part"], 22) == D("1000001500000000.000000000000001") and total["t"] == 1000001500000000.0


def test_narrow_money_is_one_column(spark):
    kind = DecimalType(18, 2)
    m = divided(F.col("a"), kind, F.col("r"), DecimalType(10, 3), 4)
    df = spark.createDataFrame([(D("10.00"), D("0.300")), (D("-10.00"), D("0.300")), (None, D("1")), (D("1"), D("0"))], "a decimal(18,2), r decimal(10,3)")
    assert len(m.limbs) == 1 and df.select(m.limbs[0].alias("q")).schema["q"].dataType == DecimalType(28, 6)
    assert [r["q"] for r in df.select(m.limbs[0].alias("q")).collect()] == [D("33.333333"), D("-33.333333"), None, None]
    assert df.select(m.times(F.lit(5_000_000_000)).total().double()).first()[0] == 0.0
    plain = divided(F.col("a").cast("double"), None, F.col("r"), DecimalType(10, 3), 4)
    assert df.select(plain.double().alias("d")).first()["d"] == pytest.approx(33.333333333)


def test_products_of_narrow_money_with_many_digits(spark):
    df = spark.createDataFrame([(D("1.12345678"), 10**12), (D("-1.00000001"), 3)], "a decimal(18,8), n bigint")
    m = Money((F.col("a"),)).times(F.col("n"), scale=8)
    w, f = df.select(m.total().limbs[0], m.total().limbs[1]).first()
    assert value(w, f, 8) == D("1123456779996.99999997")


def test_rounding_is_half_up_away_from_zero(spark):
    kind, rate = DecimalType(30, 0), DecimalType(30, 0)
    df = spark.createDataFrame([(D(1), D(32)), (D(-1), D(32)), (D(3), D(-32)), (D(1), D(3))], "a decimal(30,0), r decimal(30,0)")
    m = divided(F.col("a"), kind, F.col("r"), rate, 4)
    got = [value(*r, 4) for r in df.select(*m.limbs).collect()]
    assert got == [D("0.0313"), D("-0.0313"), D("-0.0938"), D("0.3333")]
    assert ROUND_HALF_UP  # the mode these values follow

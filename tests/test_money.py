"""Exact half-up rounding of ratios, against Python's Fraction."""

from decimal import Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from polikit.functions.money import ratio_half_up


def ref(num: int, den: int, digits: int):
    if den == 0:
        return None
    q = Fraction(num, den)
    scaled = abs(q) * 10 ** digits
    n = int(scaled) + (1 if scaled - int(scaled) >= Fraction(1, 2) else 0)
    v = n / 10 ** digits
    return -v if q < 0 else v


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(-10 ** 12, 10 ** 12), st.integers(-10 ** 6, 10 ** 6)), min_size=1, max_size=30),
       st.integers(0, 4))
def test_ratio_half_up_matches_fraction(spark, pairs, digits):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(ratio_half_up("n", "d", digits)).collect()]
    assert got == [ref(n, d, digits) for n, d in pairs]


def test_ties_round_away_from_zero(spark):
    df = spark.createDataFrame([(1005, 1000), (-1005, 1000), (1, 8), (5, 2)], "n long, d long")
    got = [r[0] for r in df.select(ratio_half_up("n", "d", 2)).collect()]
    assert got == [1.01, -1.01, 0.13, 2.5]


def test_scaled_decimals(spark):
    df = spark.createDataFrame([(Decimal("10.00"), Decimal("3.0000"))], "c decimal(18,2), p decimal(18,4)")
    got = df.select(ratio_half_up("c", "p", 4, 2, 4)).collect()[0][0]
    assert got == 3.3333


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10 ** 14, 10 ** 14), st.integers(-10 ** 9, 10 ** 9)), min_size=1, max_size=30),
       st.integers(0, 4), st.integers(0, 4), st.integers(0, 4))
def test_scales_do_not_change_integers(spark, pairs, digits, ns, ds):
    df = spark.createDataFrame(pairs, "n long, d long")
    a = df.select(ratio_half_up("n", "d", digits, ns, ds).alias("x")).collect()
    b = df.select(ratio_half_up("n", "d", digits).alias("x")).collect()
    assert a == b

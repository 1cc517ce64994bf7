"""Welch's test as column expressions.

The two-sided p-value of t at v degrees of freedom is the regularised incomplete beta function
I(v / (v + t^2); v/2, 1/2). It is its continued fraction, on whichever side of the mean that
converges fast, with as many terms as the degrees of freedom ask for.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Steps of the argument before the series for the gamma function holds to double precision.
_SHIFT = 10
_TERMS = 6


def _bernoulli(count: int) -> list[Fraction]:
    """B(0) to B(count)."""
    found: list[Fraction] = []
    for n in range(count + 1):
        known = sum((math.comb(n + 1, k) * b for k, b in enumerate(found)), Fraction(0))
        found.append(Fraction(int(n == 0)) - known / (n + 1))
    return found


def _series(z: Column) -> Column:
    """What Stirling's formula for the log of gamma leaves out."""
    numbers = _bernoulli(2 * _TERMS)
    total = F.lit(0.0)
    for k in reversed(range(1, _TERMS + 1)):
        total = total / (z * z) + float(numbers[2 * k] / (2 * k * (2 * k - 1)))
    return total / z


def log_beta_half(a: Column) -> Column:
    """log B(a, 1/2) for a > 0, without the difference of two large logarithms.

    gamma(a + 1/2) / gamma(a) is taken at a + 10, and the ten steps back are its recurrence.
    """
    z = a + float(_SHIFT)
    ratio = z * F.log1p(0.5 / z) + 0.5 * F.log(z) - 0.5 + _series(z + 0.5) - _series(z)
    for k in range(_SHIFT):
        ratio = ratio + F.log((a + float(k)) / (a + (k + 0.5)))
    return F.lit(0.5 * math.log(math.pi)) - ratio


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once. Written out, the formulas below would hold their
    inputs some hundred times, and theirs again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _fraction(a: Column, b: Column, x: Column, terms: Column) -> Column:
    """The continued fraction of the incomplete beta function, from the front (Lentz)."""
    tiny = 1e-300

    def kept(value: Column) -> Column:
        return F.when(F.abs(value) < tiny, F.lit(tiny)).otherwise(value)

    def state(c: Column, d: Column, h: Column) -> Column:
        return F.struct(c.alias("c"), d.alias("d"), h.alias("h"))

    def coefficient(k: Column, even: Column) -> Column:
        forward = k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k))
        back = -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))
        return F.when(even, forward).otherwise(back)

    def step(at: Column, n: Column) -> Column:
        # 2k stands for the even coefficient, 2k + 1 for the odd one.
        now = coefficient(F.floor(n / 2).cast("double"), n % 2 == 0)
        # What the step before has found is multiplied in by this one.
        return state(
            kept(1.0 + now / at["c"]), 1.0 / kept(1.0 + now * at["d"]), at["h"] * at["c"] * at["d"]
        )

    first = 1.0 / kept(1.0 - (a + b) * x / (a + 1.0))
    start = state(F.lit(1.0), first, F.lit(1.0))
    steps = F.sequence(F.lit(2), 2 * terms + 1)
    return F.aggregate(steps, start, step, lambda at: at["h"] * at["c"] * at["d"])


def _tails(v: Column) -> Column:
    """The p-value from (a, x, rest): half the degrees of freedom, and both shares of the square."""
    a, x, rest, half = v["a"], v["x"], v["rest"], F.lit(0.5)
    # As many terms as the convergence at its worst place asks for.
    terms = (F.lit(40.0) + 6.0 * F.sqrt(a)).cast("int")
    scale = F.exp(a * F.log(x) + 0.5 * F.log(rest) - log_beta_half(a))
    below = scale * _fraction(a, half, x, terms) / a
    above = 1.0 - scale * _fraction(half, a, rest, terms) / 0.5
    return F.when(rest == 0, F.lit(1.0)).when(x < (a + 1.0) / (a + 2.5), below).otherwise(above)


def _p_value(v: Column) -> Column:
    t, df = v["t"], v["df"]
    square = t * t
    shares = F.struct(
        (df / 2.0).alias("a"),
        (df / (df + square)).alias("x"),
        (square / (df + square)).alias("rest"),
    )
    known = (df > 0) & ~F.isnan(df) & ~F.isnan(t) & (df < float("inf"))
    return F.when(known & (F.abs(t) == float("inf")), F.lit(0.0)).when(known, _let(shares, _tails))


def student_p(t: Column, df: Column) -> Column:
    """Two-sided p-value of Student's t. Null where either is null or undefined."""
    pair = F.struct(t.cast("double").alias("t"), df.cast("double").alias("df"))
    return _let(pair, _p_value)


def welch(
    n1: Column,
    total1: Column,
    spread1: Column,
    n2: Column,
    total2: Column,
    spread2: Column,
) -> Column:
    """(t, df, p_value) of the first mean less the second, from counts, sums and sums of squared
    distances from the mean. Null with fewer than two values on a side, or without any spread."""
    values = F.struct(
        n1.alias("n1"),
        n2.alias("n2"),
        (F.try_divide(total1, n1) - F.try_divide(total2, n2)).alias("apart"),
        F.try_divide(spread1, n1 * (n1 - 1)).alias("e1"),
        F.try_divide(spread2, n2 * (n2 - 1)).alias("e2"),
    )

    def statistic(v: Column) -> Column:
        both = v["e1"] + v["e2"]
        weighed = F.try_divide(v["e1"] * v["e1"], v["n1"] - 1) + F.try_divide(
            v["e2"] * v["e2"], v["n2"] - 1
        )
        known = (v["n1"] > 1) & (v["n2"] > 1) & (both > 0) & (both < float("inf"))
        return F.struct(
            F.when(known, F.try_divide(v["apart"], F.sqrt(both))).alias("t"),
            F.when(known, F.try_divide(both * both, weighed)).alias("df"),
        )

    def tested(v: Column) -> Column:
        return F.struct(v["t"].alias("t"), v["df"].alias("df"), _p_value(v).alias("p_value"))

    return _let(_let(values, statistic), tested)

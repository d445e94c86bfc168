"""Tail probabilities for test statistics, one row per tested column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def kolmogorov_tail(distance: Column, n_a: Column, n_b: Column, terms: int = 20) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value, as an alternating series.

    Above a rate of -0.08 the p-value differs from one by less than 1e-11, and the series converges slowly or
    not at all; below it the twentieth term is under 1e-13.
    """
    a, b = n_a.cast("double"), n_b.cast("double")
    rate = F.try_divide(distance * distance * a * b, a + b) * F.lit(-2.0)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, j: total
        + F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(rate * j.cast("double") * j.cast("double")),
    )
    return F.when(rate > -0.08, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series)))


def _log_gamma(z: Column) -> Column:
    """ln of the gamma function for z > 0: Stirling's series ten places up, less the logarithm of the way there."""
    far = z + 10.0
    series = (far - 0.5) * F.ln(far) - far + 0.9189385332046728 \
        + 1 / (12 * far) - 1 / (360 * far ** 3) + 1 / (1260 * far ** 5) - 1 / (1680 * far ** 7)
    return series - F.aggregate(F.sequence(F.lit(0), F.lit(9)), F.lit(0.0), lambda total, i: total + F.ln(z + i))


def _upper_gamma(a: Column, x: Column) -> Column:
    """Regularized upper incomplete gamma function: a power series left of a + 1, a continued fraction right of it.

    Either converges in a number of steps that grows with the root of `a`.
    """
    steps = F.sequence(F.lit(1), (F.lit(100) + 10 * F.sqrt(a)).cast("int"))
    front = F.exp(a * F.ln(x) - x - _log_gamma(a + 1.0))
    one = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    series = F.aggregate(steps, one, lambda s, i: F.struct(
        (s["term"] * x / (a + i)).alias("term"), (s["total"] + s["term"] * x / (a + i)).alias("total")), lambda s: s["total"])

    def fraction(s: Column, i: Column) -> Column:  # the next partial quotient, front to back
        over, under = i * (a - i), x + 1.0 - a + 2.0 * i
        up, down = under + over / s["up"], 1.0 / (under + over * s["down"])
        return F.struct(up.alias("up"), down.alias("down"), (s["value"] * up * down).alias("value"))

    start = F.greatest(x + 1.0 - a, F.lit(1.0))  # at least 2 wherever the fraction is used
    first = F.struct(F.lit(1e300).alias("up"), (1.0 / start).alias("down"), (1.0 / start).alias("value"))
    right = F.aggregate(steps, first, fraction, lambda s: s["value"])
    return F.when(x < a + 1.0, 1.0 - front * series).otherwise(front * a * right)


def chi_square_tail(statistic: Column, degrees: Column) -> Column:
    """P(X >= statistic), in columns; NULL without a statistic or a degree of freedom."""
    x, a = statistic.cast("double") / 2.0, degrees.cast("double") / 2.0
    known = x.isNotNull() & ~F.isnan(x) & (a >= 0.5)
    tail = F.least(F.lit(1.0), F.greatest(F.lit(0.0), _upper_gamma(a, x)))
    return F.when(known, F.when(x <= 0, 1.0).otherwise(tail))


def normal_two_sided_tail(z: Column) -> Column:
    """P(|Z| >= |z|): the square of a normal value has the chi-square distribution of one degree."""
    return chi_square_tail(z.cast("double") * z.cast("double"), F.lit(1))

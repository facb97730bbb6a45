"""Statistics as Column arithmetic, so that they stay inside generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.order import computed_once


def lgamma(z: Column) -> Column:
    """ln Gamma(z) for z > 0: Stirling's series at z + 8, shifted back by the recurrence."""
    y = z + 8.0
    series = (
        (y - 0.5) * F.log(y)
        - y
        + 0.5 * math.log(2 * math.pi)
        + 1 / (12.0 * y)
        - 1 / (360.0 * F.pow(y, F.lit(3)))
        + 1 / (1260.0 * F.pow(y, F.lit(5)))
        - 1 / (1680.0 * F.pow(y, F.lit(7)))
    )
    shift = z
    for step in range(1, 8):
        shift = shift * (z + float(step))
    return series - F.log(shift)


def with_hypergeom_upper(df: DataFrame, x: Column, draws: Column, white: Column, black: Column, out: str) -> DataFrame:
    """Add P(X >= x) white balls among ``draws`` from an urn of ``white`` + ``black`` balls.

    Urn sizes and draws are rounded half to even and x is floored. When x cannot be missed
    the result is exactly 1. Terms are summed away from the mode, where they only fall: above
    the mode upwards from x, otherwise downwards from x - 1 and taken from 1. The sum starts with one
    log-gamma term and goes on by the ratio r of neighbouring terms, which falls too, so s terms leave
    less than r(s / 2) ** (s / 2) of the first; the range is the least power of two for which
    that is below double precision.

    Intermediate values are computed once, so that the plan does not repeat them.
    """
    w, b, n, k0 = (F.col(f"_u.{c}") for c in "wbnk")
    urn = F.struct(
        F.bround(white).cast("double").alias("w"),
        F.bround(black).cast("double").alias("b"),
        F.bround(draws).cast("double").alias("n"),
        F.floor(x + 1e-7).cast("double").alias("k"),
    )
    certain = F.greatest(F.lit(0.0), n - b)
    last = F.least(n, w)
    mode = F.floor((n + 1.0) * (w + 1.0) / (w + b + 2.0)).cast("double")
    start, up, room, steps = F.col("_start"), F.col("_up"), F.col("_room"), F.col("_steps")
    gammas = F.transform(
        F.array(w, start, w - start, b, n - start, b - n + start, w + b, n, w + b - n), lambda z: lgamma(z + 1.0)
    )
    signs = [1, -1, -1, 1, -1, -1, -1, 1, 1]
    log_term = F.aggregate(
        F.zip_with("_gammas", F.array(*[F.lit(float(s)) for s in signs]), lambda g, s: g * s),
        F.lit(0.0),
        lambda total, term: total + term,
    )

    def ratio(step: Column) -> Column:
        """Next term by this one, ``step`` terms away from the start."""
        k = F.when(up, start + step).otherwise(start - step)
        rising = (w - k) * (n - k) / ((k + 1.0) * (b - n + k + 1.0))
        falling = k * (b - n + k) / ((w - k + 1.0) * (n - k + 1.0))
        return F.when(up, rising).otherwise(falling)

    def spent(half: Column) -> Column:
        return (half >= room) | (half * F.log(F.greatest(ratio(F.least(half, room)), F.lit(1e-300))) < -42.0)

    halves = F.array(*[F.lit(float(2**i)) for i in range(5, 50)])

    def add(acc: Column, step: Column) -> Column:
        return F.struct((acc["total"] + acc["term"]).alias("total"), (acc["term"] * ratio(step)).alias("term"))

    zero = F.struct(F.lit(0.0).alias("total"), F.exp("_log_term").alias("term"))
    total = F.aggregate(F.sequence(F.lit(0).cast("long"), steps), zero, add, lambda acc: acc["total"])
    open_case = (k0 > certain) & (k0 <= last)
    p = (
        F.when(k0 <= certain, F.lit(1.0))
        .when(k0 > last, F.lit(0.0))
        .otherwise(F.greatest(F.least(F.when(up, total).otherwise(1.0 - total), F.lit(1.0)), F.lit(0.0)))
    )
    placed = computed_once(
        computed_once(df, _u=urn), _start=F.when(open_case, F.when(k0 > mode, k0).otherwise(k0 - 1.0)), _up=k0 > mode
    )
    roomy = computed_once(placed, _room=F.when(up, last - start).otherwise(start - certain))
    bounded = computed_once(
        roomy,
        _steps=F.when(start.isNotNull(), F.least(room, 2.0 * F.get(F.filter(halves, spent), F.lit(0))).cast("long")),
        _gammas=F.when(start.isNotNull(), gammas),
    )
    summed = computed_once(computed_once(bounded, _log_term=log_term), **{out: p})
    return summed.drop("_u", "_start", "_up", "_room", "_steps", "_gammas", "_log_term")


def fisher_combine(p1: Column, p2: Column) -> Column:
    """Fisher's method for two p-values; chi-squared with 4 df has a closed upper tail."""
    p = p1 * p2
    return F.when(p == 0, F.lit(0.0)).otherwise(p * (1.0 - F.log(p)))


def two_sided_normal(z: Column) -> Column:
    """P(|Z| >= |z|): the complementary error function as a published Chebyshev fit."""
    # Coefficients of the rational fit (relative error below 1.2e-7).
    coefficients = [
        -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
        0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
    ]
    x = F.abs(z) / math.sqrt(2.0)
    t = 1.0 / (1.0 + 0.5 * x)
    poly = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        poly = poly * t + c
    return t * F.exp(poly - x * x)

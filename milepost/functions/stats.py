"""Statistical expressions made of built-in functions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rational approximation of the error function
# (Abramowitz and Stegun, 7.1.26; absolute error below 1.5e-7).
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)

# Inverse of the normal distribution (Wichura 1988, AS 241, PPND16), as
# numerator and denominator by rising power, for the middle, the sides and the far ends.
PROBIT_MIDDLE = (
    (3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
     45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727),
    (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
     21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610),
)
PROBIT_SIDE = (
    (1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
     1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
     0.148103976427480074590, 0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
PROBIT_END = (
    (6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
     0.0265321895265761230930, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)
# Upper tail of the normal distribution (Hill 1973, AS 66), middle and tail.
TAIL_P = (0.398942280444, 0.399903438504)
TAIL_A = ((5.75885480458, -29.8213557807), (2.62433121679, 48.6959930692), (5.92885724438, None))
TAIL_R = 0.398942280385
TAIL_C = (
    (-3.8052e-8, 1.00000615302), (3.98064794e-4, 1.98615381364), (-0.151679116635, 5.29330324926),
    (4.8385912808, -15.1508972451), (0.742380924027, 30.789933034), (3.99019417011, None),
)
# Weights and significance of the W test (Royston 1995, AS R94).
W_LAST = (0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056)
W_NEXT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
W_FEW_MEAN = (0.5440, -0.39978, 0.025054, -6.714e-4)
W_FEW_SPREAD = (1.3822, -0.77857, 0.062767, -0.0020322)
W_MANY_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
W_MANY_SPREAD = (-0.4803, -0.082676, 0.0030302)
W_GAMMA = (-2.273, 0.459)


def polynomial(coefficients: tuple[float, ...], x: Column) -> Column:
    """Value of the polynomial whose coefficients rise in power."""
    value = F.lit(coefficients[-1])
    for coefficient in reversed(coefficients[:-1]):
        value = value * x + F.lit(coefficient)
    return value


def erf(x: Column) -> Column:
    size = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * size)
    poly = F.lit(0.0)
    for coefficient in reversed(ERF_A):
        poly = (poly + F.lit(coefficient)) * t
    return F.signum(x) * (F.lit(1.0) - poly * F.exp(-size * size))


def normal_cdf(z: Column) -> Column:
    return F.lit(0.5) * (F.lit(1.0) + erf(z / F.lit(math.sqrt(2.0))))


def standard_score(delay: Column, mean: Column, std: Column) -> Column:
    """Delay in deviations from its mean, NaN when unknown or without spread.

    NaN instead of NULL keeps the long formula built on it free of null checks, small
    enough for the JVM to compile.
    """
    return F.coalesce(F.try_divide(delay - mean, std), F.lit(float("nan")))


def late_probability(score: Column) -> Column:
    """Chance in percent that a normal delay exceeds the one with this score."""
    chance = F.lit(100.0) * (F.lit(1.0) - normal_cdf(score))
    return F.nullif(chance, F.lit(float("nan")))


def outside(value: Column, mean: Column, std: Column, z: float) -> Column:
    """Strictly beyond ``z`` standard deviations; an unknown bound or value is inside."""
    span = F.lit(z) * std
    return F.coalesce((value > mean + span) | (value < mean - span), F.lit(False))


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows with both values; NULL when one of them is constant."""
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


def jarque_bera(x: Column) -> Column:
    """Normality statistic from the third and fourth moments."""
    return (F.count(x) / 6.0) * (
        F.pow(F.skewness(x), F.lit(2)) + F.pow(F.kurtosis(x), F.lit(2)) / 4.0
    )


def quantile_parts(p: Column) -> dict[str, Column]:
    """What ``quantile_of`` needs of a chance: the distance from one half and the depth of the tail."""
    return {"q": p - 0.5, "r": F.sqrt(-F.log(F.least(p, 1.0 - p)))}


def quantile_of(q: Column, r: Column) -> Column:
    """Value that a standard normal variable stays below, by the parts of its chance."""

    def ratio(parts, x):
        return polynomial(parts[0], x) / polynomial(parts[1], x)

    side = F.when(r <= 5.0, ratio(PROBIT_SIDE, r - 1.6)).otherwise(ratio(PROBIT_END, r - 5.0))
    return F.when(F.abs(q) <= 0.425, q * ratio(PROBIT_MIDDLE, 0.180625 - q * q)).otherwise(F.signum(q) * side)


def normal_quantile(p: Column) -> Column:
    """Value that a standard normal variable stays below with chance ``p``."""
    return quantile_of(**quantile_parts(p))


def normal_upper(z: Column) -> Column:
    """Chance that a standard normal variable exceeds ``z``; relative error about 1e-9."""
    size = F.abs(z)
    y = size * size / 2.0
    inner, outer = y + TAIL_A[-1][0], size + TAIL_C[-1][0]
    for a, b in reversed(TAIL_A[:-1]):
        inner = y + a + F.lit(b) / inner
    for c, d in reversed(TAIL_C[:-1]):
        outer = size + c + F.lit(d) / outer
    middle = F.lit(0.5) - size * (F.lit(TAIL_P[0]) - F.lit(TAIL_P[1]) * y / inner)
    upper = F.when(size <= 1.28, middle).otherwise(F.lit(TAIL_R) * F.exp(-y) / outer)
    return F.when(z >= 0, upper).otherwise(1.0 - upper)


def order_scores(rows: DataFrame, place: str, n: str, out: str) -> DataFrame:
    """``rows`` with the expected normal value of the row at ``place`` (from 0) of ``n`` ordered ones.

    In three projections: as one expression, the formulas of the inner values would be repeated
    in every step of the polynomials, too long a method for the JVM to compile.
    """
    chance, depth = f"{out}_chance", {"q": f"{out}_q", "r": f"{out}_r"}
    parted = rows.withColumn(chance, (F.col(place) + 0.625) / (F.col(n) + 0.25))
    parted = parted.withColumns({depth[k]: c for k, c in quantile_parts(F.col(chance)).items()})
    score = quantile_of(**{k: F.col(name) for k, name in depth.items()})
    return parted.withColumn(out, score).drop(chance, *depth.values())


def w_parts(x: Column, place: Column, n: Column, score: Column) -> dict[str, Column]:
    """Mergeable sums of one group that the W test needs.

    ``place`` counts from 0 in order of ``x``, ``score`` is that of ``order_scores``.
    """

    def at(k):
        return F.max(F.when(place == k, x))

    return {
        "n": F.count("*"),
        "scores": F.sum(score * score),
        "scored": F.sum(score * x),
        "squares": F.var_pop(x) * F.count(x),
        "low": F.min(x),
        "high": F.max(x),
        "next_low": at(F.lit(1)),
        "next_high": at(n - 2),
        # The two largest scores; with three rows the second is that of the middle, 0.
        "last": F.max(score),
        "before": F.max(F.when(place == n - 2, score)),
    }


def w_test(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, n, w and p_value from the columns of ``w_parts``, one row a group.

    W is the squared correlation of the ordered rows with Royston's weights: the outer two at
    each end (one below six rows) by his polynomials, the others by their scores over one length.
    p_value is the chance of a smaller W under normality. Groups of less than three rows, or of
    equal values, have neither.
    """
    n = F.col("n").cast("double")
    three, few = F.col("n") == 3, F.col("n") <= 5
    root, back = F.sqrt("scores"), F.lit(1.0) / F.sqrt(n)
    last, before, end, inner = (F.col(c) for c in ("last", "before", "end", "inner"))
    parts = parts.withColumns(
        {
            "end": F.when(three, math.sqrt(0.5)).otherwise(polynomial(W_LAST, back) + F.try_divide(last, root)),
            "inner": F.when(few, 0.0).otherwise(polynomial(W_NEXT, back) + F.try_divide(before, root)),
            "before": F.when(few, 0.0).otherwise(before),
            "ends": F.col("high") - F.col("low"),
            "nexts": F.when(few, 0.0).otherwise(F.col("next_high") - F.col("next_low")),
        }
    )
    left = F.col("scores") - 2.0 * last * last - 2.0 * before * before
    length = F.sqrt(F.try_divide(left, 1.0 - 2.0 * end * end - 2.0 * inner * inner))
    rest = F.col("scored") - last * F.col("ends") - before * F.col("nexts")
    middle = F.when(three, 0.0).otherwise(F.try_divide(rest, length))
    parts = parts.withColumn("sum", end * F.col("ends") + inner * F.col("nexts") + middle)
    known = (F.col("n") >= 3) & (F.col("high") > F.col("low"))
    w = F.least(F.try_divide(F.col("sum") * F.col("sum"), F.col("squares")), F.lit(1.0))
    parts = parts.withColumn("w", F.when(known, w))
    parts = parts.withColumns({"y": F.log(1.0 - F.col("w")), "size": F.log(n), "bound": polynomial(W_GAMMA, n)})
    y, size, bound, w = (F.col(c) for c in ("y", "size", "bound", "w"))
    few_z = (-F.log(bound - y) - polynomial(W_FEW_MEAN, n)) / F.exp(polynomial(W_FEW_SPREAD, n))
    many_z = (y - polynomial(W_MANY_MEAN, size)) / F.exp(polynomial(W_MANY_SPREAD, size))
    parts = parts.withColumn("z", F.when(F.col("n") > 11, many_z).otherwise(few_z))
    exact = F.greatest(F.lit(6.0 / math.pi) * (F.asin(F.sqrt(w)) - math.asin(math.sqrt(0.75))), F.lit(0.0))
    p = (
        F.when(three, exact)
        .when(w >= 1.0, F.lit(1.0))
        .when((F.col("n") <= 11) & (y >= bound), F.lit(0.0))
        .otherwise(normal_upper(F.col("z")))
    )
    return parts.select(*keys, "n", "w", p.alias("p_value"))

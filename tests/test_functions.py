from __future__ import annotations

import datetime as dt
import math
import random
import re
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from milepost.functions import dates, rules, stats, text
from milepost.plans import training


def one(spark, expr, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first().v


def expand(units: str) -> list[int]:
    """Plain reading of a unit list: every number, and all numbers between range ends."""
    found: list[int] = []
    previous = None
    for mark, number in re.findall(r"([ae,-]?)\s*(\d+)", units):
        value = int(number)
        if mark in ("a", "-") and previous is not None:
            found += range(previous + 1, value)
        found.append(value)
        previous = value
    return sorted(found)


@pytest.mark.parametrize(
    "units, expected",
    [
        ("01 a 04 e 06 a 08, 11,15 a 18", [1, 2, 3, 4, 6, 7, 8, 11, 15, 16, 17, 18]),
        ("4 a 1", [1, 4]),
        ("1a4a7", [1, 2, 3, 4, 5, 6, 7]),
        ("1-3", [1, 2, 3]),
        ("7", [7]),
        ("um", None),
        (None, None),
    ],
)
def test_unit_list(spark, units, expected):
    col = F.col("u")
    row = spark.createDataFrame([(units,)], "u string").select(
        text.unit_list(col).alias("l"), text.unit_count(col).alias("n")
    ).first()
    assert row.l == expected
    assert row.n == (None if expected is None else len(expected))


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from([" a ", ", ", " e ", "-"]), st.integers(1, 60)),
        min_size=1,
        max_size=6,
    )
)
def test_unit_list_against_plain_reading(spark, parts):
    units = "0" + "".join(m + str(n) for m, n in [("", parts[0][1]), *parts[1:]])
    row = spark.createDataFrame([(units,)], "u string").select(
        text.unit_list(F.col("u")).alias("l"), text.unit_count(F.col("u")).alias("n")
    ).first()
    assert row.l == expand(units)
    assert row.n == len(row.l)


def test_normal_cdf_close_to_exact(spark):
    zs = [i / 10 for i in range(-60, 61)]
    rows = spark.createDataFrame([(z,) for z in zs], "z double").select(
        "z", stats.normal_cdf(F.col("z")).alias("p")
    )
    for row in rows.collect():
        assert abs(row.p - 0.5 * (1 + math.erf(row.z / math.sqrt(2)))) < 1.5e-7


def test_month_end_in_december(spark):
    value = one(spark, dates.month_end(dt.date(2023, 12, 5)))
    assert value == dt.datetime(2023, 12, 31, 23, 59, 59)
    value = one(spark, dates.month_end_of(F.col("d")), "d date", (dt.date(2024, 2, 3),))
    assert value == dt.datetime(2024, 2, 29, 23, 59, 59)


def test_days_with_time_of_day(spark):
    row = (dt.datetime(2024, 1, 2, 6), dt.datetime(2024, 1, 1, 18))
    schema = "a timestamp_ntz, b timestamp_ntz"
    assert one(spark, dates.days_between(F.col("a"), F.col("b")), schema, row) == 0.5
    assert one(spark, dates.whole_days(F.col("b"), F.col("a")), schema, row) == -1
    assert one(spark, dates.add_days(F.col("b"), F.lit(0.25)), schema, row) == dt.datetime(2024, 1, 2)


def test_rule_combinators(spark):
    x = F.col("x")
    branches = [(x > 0, "a"), (x == 1, "b")]
    assert one(spark, rules.first_match(branches, "z")) == "a"
    assert one(spark, rules.last_match(branches, "z")) == "b"
    unknown = F.lit(None).cast("string")
    assert one(spark, rules.monitored(unknown)) is True
    assert one(spark, rules.monitored(F.lit("Não"))) is False
    assert one(spark, rules.differs(unknown, "OT")) is True
    assert one(spark, rules.any_of(unknown == "a", F.lit(False))) is False


def test_constant_x_gives_unknown_line(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    row = df.agg(
        F.regr_slope("y", "x").alias("a"), stats.pearson(F.col("x"), F.col("y")).alias("r")
    ).first()
    assert row.a is None and row.r is None


def test_no_spread_gives_unknown_chance(spark):
    score = stats.standard_score(F.lit(1.0), F.lit(0.0), F.lit(0.0))
    assert one(spark, stats.late_probability(score)) is None


def test_decode(spark):
    assert one(spark, text.decode_escapes(F.lit("a_x0020__x0028_b_x002C__x0029_"))) == "a (b,)"
    assert one(spark, text.has_split_digits(F.lit("1 2"))) is True


# --- normal distribution and the W test ---------------------------------------


def test_normal_quantile_and_tail(spark):
    values = [1e-12, 1e-5, 0.01, 0.07, 0.075, 0.3, 0.5, 0.7, 0.925, 0.95, 0.9999, 1 - 1e-9]
    row = spark.createDataFrame([(v,) for v in values], "p double").select("p", stats.normal_quantile(F.col("p")).alias("z"))
    for r in row.collect():
        assert r.z == pytest.approx(statistics.NormalDist().inv_cdf(r.p), rel=1e-12, abs=1e-14)
    values = [-9.0, -3.0, -1.28, -0.5, 0.0, 0.5, 1.28, 1.2801, 2.0, 5.0, 12.0]
    row = spark.createDataFrame([(v,) for v in values], "z double").select("z", stats.normal_upper(F.col("z")).alias("p"))
    for r in row.collect():
        assert r.p == pytest.approx(0.5 * math.erfc(r.z / math.sqrt(2)), rel=1e-7)


def w_by_hand(values):
    """The test as published, on a sorted list in one place."""
    x, n = sorted(values), len(values)
    if n < 3 or x[0] == x[-1]:
        return None, None
    normal = statistics.NormalDist()
    m = [normal.inv_cdf((i + 1 - 0.375) / (n + 0.25)) for i in range(n)]
    poly = lambda c, t: sum(a * t**k for k, a in enumerate(c))
    square, u = sum(v * v for v in m), 1 / math.sqrt(n)
    a = [0.0] * n
    if n == 3:
        a = [-math.sqrt(0.5), 0.0, math.sqrt(0.5)]
    else:
        a[-1] = poly([0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056], u) + m[-1] / math.sqrt(square)
        own = 1
        if n > 5:
            a[-2] = poly([0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633], u) + m[-2] / math.sqrt(square)
            own = 2
        ends = range(n - own, n)
        phi = (square - 2 * sum(m[i] ** 2 for i in ends)) / (1 - 2 * sum(a[i] ** 2 for i in ends))
        for i in range(own, n - own):
            a[i] = m[i] / math.sqrt(phi)
        for i in range(own):
            a[i] = -a[n - 1 - i]
    mean = sum(x) / n
    w = min(1.0, sum(p * q for p, q in zip(a, x, strict=True)) ** 2 / sum((v - mean) ** 2 for v in x))
    if n == 3:
        return w, max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if w >= 1:
        return w, 1.0
    y, size = math.log(1 - w), math.log(n)
    if n <= 11:
        bound = poly([-2.273, 0.459], n)
        if y >= bound:
            return w, 0.0
        z = (-math.log(bound - y) - poly([0.544, -0.39978, 0.025054, -6.714e-4], n)) / math.exp(
            poly([1.3822, -0.77857, 0.062767, -0.0020322], n)
        )
    else:
        z = (y - poly([-1.5861, -0.31082, -0.083751, 0.0038915], size)) / math.exp(poly([-0.4803, -0.082676, 0.0030302], size))
    return w, 0.5 * math.erfc(z / math.sqrt(2))


def test_w_test_by_ranks(spark):
    rng = random.Random(5)
    groups = {f"n{n}": [rng.gauss(3, 2) for _ in range(n)] for n in (1, 2, 3, 4, 5, 6, 7, 11, 12, 30, 500)}
    groups |= {
        "weights": [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236],  # a published example
        "ties": [float(rng.randrange(6)) for _ in range(200)],
        "skewed": [rng.expovariate(1) for _ in range(3000)],
        "equal": [4.0] * 9,
        "spike": [0.0] * 9 + [1000.0],
        "line": [1.0, 2.0, 3.0],
        None: [rng.gauss(0, 1) for _ in range(50)],
    }
    data = [(g, float(v), -float(v)) for g, vs in groups.items() for v in vs] + [("ties", None, None), ("n30", None, 1.0)]
    df = spark.createDataFrame(data, "g string, a double, b double").repartition(5)
    found = {(r.g, r.variable): r for r in training.normality_by_order(df, ["g"], ["a", "b"]).collect()}
    for g, values in groups.items():
        for variable, sign in (("a", 1), ("b", -1)):
            vs = [sign * v for v in values] + ([1.0] if (g, variable) == ("n30", "b") else [])
            w, p = w_by_hand(vs)
            r = found[(g, variable)]
            assert r.n == len(vs)
            assert r.w == (None if w is None else pytest.approx(w, rel=1e-9))
            assert r.p_value == (None if p is None else pytest.approx(p, rel=1e-5, abs=1e-9))
    r = found[("weights", "a")]
    assert r.w == pytest.approx(0.7888146948631716, rel=1e-6) and r.p_value == pytest.approx(0.006703814061898823, rel=1e-4)
    try:
        from scipy.stats import shapiro
    except ImportError:
        return
    for g in ("n12", "n500", "ties"):
        assert found[(g, "a")].w == pytest.approx(shapiro(groups[g]).statistic, rel=1e-5)


def test_no_group_is_gathered_for_the_w_test(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), (F.col("id") * 7 % 5000).cast("double").alias("x"))
    tested = training.normality_by_order(df, ["g"], ["x"])
    text = tested._jdf.queryExecution().executedPlan().toString()
    # The only window is over one row per group and partition; sums are combined before the shuffle.
    assert "SinglePartition" not in text and "partial_sum" in text and "collect_" not in text
    windows = [line for line in text.split("\n") if "Window [" in line]
    assert windows and all("_rows" in line for line in windows)
    assert tested.first().n == 5000

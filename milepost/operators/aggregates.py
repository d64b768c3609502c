"""Grouped summaries. All use mergeable aggregates, combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.functions.dates import epoch_days
from milepost.functions.rules import holds
from milepost.functions.stats import outside
from milepost.operators.setops import grid, key_values
from milepost.session import staged

SUMMARY_FUNCTIONS = {
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "std": F.stddev_samp,
    "count": F.count,
}


def group_max(df: DataFrame, key: str, cols: dict[str, str]) -> DataFrame:
    """Largest value of several columns per key in one pass."""
    return df.groupBy(key).agg(*[F.max(c).alias(name) for c, name in cols.items()])


def group_any(df: DataFrame, key: str, flags: dict) -> DataFrame:
    """Whether a condition holds on any row of the key; ``flags`` maps name to condition."""
    return df.groupBy(key).agg(*[F.bool_or(holds(c)).alias(n) for n, c in flags.items()])


def collapse_units(df: DataFrame, power: str, size: str | None = None) -> DataFrame:
    """Merge rows equal in all other columns, unknown values forming a group too.

    Gives the number of merged units and their power; a group without power sums to 0.
    """
    dropped = [power] + ([size] if size else [])
    quantity = F.coalesce(F.sum(size), F.lit(0)) if size else F.count(power)
    return df.groupBy(*[c for c in df.columns if c not in dropped]).agg(
        quantity.cast("bigint").alias("unit_count"),
        F.coalesce(F.sum(power), F.lit(0.0)).alias("total_power"),
    )


def conservation(units: DataFrame, collapsed: DataFrame, power: str) -> DataFrame:
    """Units and power lost by collapsing; both zero when nothing was lost."""
    before = units.select(
        F.when(F.col(power).isNotNull(), 1).otherwise(0).alias("u"), F.col(power).alias("p")
    )
    after = collapsed.select((-F.col("unit_count")).alias("u"), (-F.col("total_power")).alias("p"))
    return before.union(after).agg(
        F.sum("u").cast("bigint").alias("unit_diff"),
        F.coalesce(F.sum("p"), F.lit(0.0)).alias("power_diff"),
    )


def group_summary(
    df: DataFrame, keys: list[str], cols: list[str], funcs: list[str], z: float | None = None
) -> DataFrame:
    """Summary of every column for every combination of key values, empty ones included.

    Dates are summarised as days since 1970. With ``z`` numeric values beyond that many
    standard deviations of their group are left out first; dates never are.
    """
    types = dict(df.dtypes)
    dates = [c for c in cols if types[c].startswith(("date", "timestamp"))]
    data = df.select(*keys, *[epoch_days(F.col(c)).alias(c) if c in dates else c for c in cols])
    summaries = {f"{c}_{f}": SUMMARY_FUNCTIONS[f](c) for c in cols for f in funcs}
    which = "_which"
    if z is None:
        both = staged(key_values(data, keys, summaries, which))
        cells = both.filter(F.col(which) == 0).drop(which)
    else:
        numeric = [c for c in cols if c not in dates]
        spread = {f"_m_{c}": F.avg(c) for c in numeric} | {f"_s_{c}": F.stddev_samp(c) for c in numeric}
        both = staged(key_values(data, keys, spread, which))
        bounds = both.filter(F.col(which) == 0).drop(which)
        inside = [
            F.when(~outside(F.col(c), F.col(f"_m_{c}"), F.col(f"_s_{c}"), z), F.col(c)).alias(c)
            for c in numeric
        ]
        trimmed = data.join(bounds, keys).select(*keys, *dates, *inside)
        cells = trimmed.groupBy(*keys).agg(*[c.alias(name) for name, c in summaries.items()])
    counts = [f"{c}_count" for c in cols] if "count" in funcs else []
    return grid(both, keys, which).join(cells, keys, "left").fillna(0, counts)


def inconsistent_keys(df: DataFrame, key: str, col: str) -> DataFrame:
    """Keys that carry more than one distinct value of ``col``."""
    return df.groupBy(key).agg(F.count_distinct(col).alias("n")).filter("n > 1")


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows per combination of values, unknown values counted as a value."""
    return df.groupBy(*cols).agg(F.count("*").alias("n"))

"""Profiles of a result table and comparison with another system's results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.functions.dates import midnight, days_between
from milepost.functions.rules import any_of, differs
from milepost.functions.text import decode_escapes
from milepost.operators.aggregates import inconsistent_keys
from milepost.operators.joins import compare

_MOST_ROOM = 26  # bits of the largest sketch


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with no value or a single one, each with its number of known values.

    Smallest equals largest is enough to know: one pass, nothing but two values per
    column is shuffled.
    """
    facts = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("known"),
                F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias("constant"),
            ).alias(c)
            for c in df.columns
        ]
    )
    rows = facts.select(F.inline(F.array(*[F.col(f"`{c}`") for c in df.columns])))
    return rows.filter("constant").select("column", "known")


def many_valued(df: DataFrame, columns: list[str], k: int) -> set[str]:
    """Columns with more than ``k`` distinct values, the unknown one counted as a value.

    One pass keeps, per column, the smallest hashes of its values, which merge between tasks
    (a theta sketch). While a column has no more values than the sketch has room for, above
    ``k``, the count is exact; beyond, the estimate is never below that room. So the answer is
    exact for every ``k``, and each column costs the same bounded buffer.
    """
    room = max(4, (k + 1).bit_length())
    if room > _MOST_ROOM:
        raise ValueError(f"many_valued: k is {2**_MOST_ROOM - 1} at most")
    facts = df.agg(
        *[
            (
                # The letter keeps empty texts, which a sketch passes over.
                F.theta_sketch_estimate(F.theta_sketch_agg(F.concat(F.lit("v"), F.col(f"`{c}`").cast("string")), room))
                + F.coalesce(F.max(F.col(f"`{c}`").isNull().cast("int")), F.lit(0))
            ).alias(f"n{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    return {c for i, c in enumerate(columns) if facts[i] > k}


def show_cases(
    df: DataFrame, columns: list[str] | None = None, k: int = 5, example_by: list[str] = (), whole: bool = False
) -> DataFrame:
    """One example row and the row count of every combination of values in ``columns`` (all by default).

    A column with more than ``k`` distinct values only counts as known or unknown. The example
    is the first row by ``example_by``, else by all columns; with ``whole`` it has all columns.
    """
    columns = list(columns or df.columns)
    wide = many_valued(df, columns, k)
    cases = {
        f"{c}_case": F.col(f"`{c}`").isNotNull() if c in wide else F.col(f"`{c}`") for c in columns
    }
    shown = df.columns if whole else columns
    quoted = lambda names: [F.col(f"`{c}`") for c in names]
    example = F.min_by(F.struct(*quoted(shown)), F.struct(*quoted(example_by or df.columns)))
    return (
        df.groupBy(*[expr.alias(name) for name, expr in cases.items()])
        .agg(example.alias("_example"), F.count("*").alias("n"))
        .select("_example.*", *quoted(cases), "n")
    )


def readable_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: decode_escapes(F.col(c)) for c in columns})


def forecast_differences(ours: DataFrame, theirs: DataFrame, keys: list[str]) -> DataFrame:
    """Days between the forecasts of two systems on every key of either."""
    theirs = theirs.withColumn("forecast", midnight(F.col("forecast")))
    both = compare(ours, theirs, keys, ["phase", "forecast"], ("_ours", "_theirs"))
    return both.withColumn(
        "diff_days", days_between(F.col("forecast_ours"), F.col("forecast_theirs"))
    )


def compare_systems(ours: DataFrame, theirs: DataFrame, columns: list[str]) -> DataFrame:
    """Plants whose criterion or texts differ; plants with two criteria over there left out."""
    split = inconsistent_keys(theirs, "plant_id", "criterion_pmo").select("plant_id")
    distinct = theirs.select("plant_id", *[F.col(f"`{c}`") for c in columns]).distinct()
    both = compare(ours, distinct, ["plant_id"], columns, ("_ours", "_theirs"))
    flags = {f"{c}_differs": differs(F.col(f"`{c}_ours`"), F.col(f"`{c}_theirs`")) for c in columns}
    changed = any_of(*[F.col(f"`{name}`") for name in flags])
    return both.join(split, "plant_id", "left_anti").withColumns(flags).filter(changed)

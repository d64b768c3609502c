"""Places of rows inside their groups, without a window over a group.

Rows are range-partitioned by group and order, so a large group spreads over many tasks. Each
row's number in its partition, the group's rows in the partitions before and the group's first
row there give its place. Only one row per group and partition passes a window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.session import staged

_PARTITION_BITS = 33  # rows of a partition are numbered below this bit


def unused(names: list[str], name: str) -> str:
    """``name``, lengthened until it is none of ``names``."""
    while name in names:
        name += "_"
    return name


def all_equal(pairs: list[tuple[Column, Column]]) -> Column:
    """Whether all pairs are equal, unknown equal to unknown."""
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) for a, b in pairs])


def numbered(
    df: DataFrame,
    groups: list[str],
    order: list[str | Column],
    place: str = "place",
    size: str = "size",
    only: str | None = None,
) -> DataFrame:
    """``df`` with the place of each row in its group (from 0) and the group's number of rows.

    Unknown group values form a group. Rows equal in the whole order get places in any order.
    With the boolean column ``only``, rows for which it is true come first in their group, so
    their places have no gaps; ``size`` still counts all rows. The input is read once: the
    ordered rows are written as a stage table.
    """
    if not groups:
        raise ValueError("numbered: at least one group column")
    if {place, size} & set(df.columns):
        raise ValueError("numbered: the new columns need names of their own")
    id_ = unused(df.columns, "_id")
    keys = [*(F.col(f"`{g}`") for g in groups), *([F.col(only).desc()] if only else []), *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = staged(dealt.withColumn(id_, F.monotonically_increasing_id()))
    names = {g: unused(df.columns, f"_group_{k}") for k, g in enumerate(groups)}
    part, least, rows, offset = (unused(df.columns, x) for x in ("_part", "_least", "_rows", "_offset"))
    own = F.shiftright(id_, _PARTITION_BITS)
    runs = dealt.groupBy(*[F.col(f"`{g}`").alias(n) for g, n in names.items()], own.alias(part)).agg(
        F.min(id_).alias(least), F.count("*").alias(rows)
    )
    whole = Window.partitionBy(*names.values())
    before = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *names.values(),
        part,
        least,
        F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(offset),
        F.sum(rows).over(whole).alias(size),
    )
    meet = all_equal([(dealt[f"`{g}`"], runs[n]) for g, n in names.items()]) & (own == runs[part])
    joined = dealt.join(runs, meet)
    at = (F.col(id_) - F.col(least) + F.col(offset)).alias(place)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], at, size)

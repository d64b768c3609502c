"""Unions, products, intersections, top rows and repeatable samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.operators.ranks import numbered, unused
from milepost.session import staged


def union_with_origin(parts: dict[str, DataFrame], tag: str = "origin") -> DataFrame:
    """Stack frames with differing columns and mark where each row came from."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def shared_values(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` present on both sides."""
    return a.select(col).intersect(b.select(col))


def key_values(df: DataFrame, keys: list[str], cells: dict[str, Column], which: str) -> DataFrame:
    """One GROUPING SETS aggregate: ``cells`` per combination of all keys and per single key.

    ``which`` is 0 for the rows of all keys, else the bits of the keys left out.
    """
    sets = [list(keys)] + ([[k] for k in keys] if len(keys) > 1 else [])
    return df.groupingSets(sets, *keys).agg(
        F.grouping_id().cast("int").alias(which), *[c.alias(name) for name, c in cells.items()]
    )


def grid(values: DataFrame, keys: list[str], which: str) -> DataFrame:
    """Every combination of known key values, from the single-key rows of ``key_values``.

    The values of a key are numbered; a combination so far is repeated once per number of the
    next key and meets the value with its number by an ordinary join.
    """
    bits = (1 << len(keys)) - 1
    own = {k: bits & ~(1 << (len(keys) - 1 - i)) if len(keys) > 1 else 0 for i, k in enumerate(keys)}
    known = reduce(lambda a, b: a | b, [(F.col(which) == bit) & F.col(f"`{k}`").isNotNull() for k, bit in own.items()])
    order = [F.col(f"`{k}`") for k in keys]
    places = numbered(values.filter(known).select(which, *order), [which], order, "_place", "_size")
    places = staged(places)
    sizes = {r[0]: r[1] for r in places.groupBy(which).agg(F.max("_size")).collect()}  # one row a key
    first, *rest = keys
    product = places.filter(F.col(which) == own[first]).select(F.col(f"`{first}`"))
    for k in rest:
        if own[k] not in sizes:
            return product.limit(0).select(first, *[F.lit(None).cast(values.schema[x].dataType).alias(x) for x in rest])
        numbers = F.explode(F.sequence(F.lit(0), F.lit(sizes[own[k]] - 1)))
        value = places.filter(F.col(which) == own[k]).select(F.col(f"`{k}`"), F.col("_place").alias("_number"))
        product = product.withColumn("_number", numbers).join(value, "_number").drop("_number")
    return product


def key_product(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every combination of the known values of the key columns, seen together or not."""
    which = unused(df.columns, "_which")
    return grid(key_values(df, keys, {}, which), keys, which)


def top_rows(df: DataFrame, by: Column, n: int, ties: list[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest ``by``; partitions keep only their own top ``n``."""
    return df.orderBy(by.desc_nulls_last(), *ties).limit(n)


def seeded_sample(df: DataFrame, keys: list[str], n: int, seed: int) -> DataFrame:
    """``n`` rows drawn by a hash of their key and the seed: repeatable at any partitioning."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return df.withColumn("_h", F.md5(text)).orderBy("_h", *keys).limit(n).drop("_h")

"""Joins with the matching rules the plans need."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.operators.ranks import all_equal, unused
from milepost.session import staged


# Rows without any known key are dealt over this many parts; the other side's are copied to each.
UNKNOWN_PARTS = 32


def _unknown(keys: list[str]) -> Column:
    """Rows whose keys are all unknown: a single group, whatever the table."""
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNull() for k in keys])


def copied(df: DataFrame, keys: list[str], copy: str) -> DataFrame:
    """``df`` with the part each row meets: all parts for rows without any known key, else part 0."""
    every = F.sequence(F.lit(0), F.lit(UNKNOWN_PARTS - 1))
    return df.withColumn(copy, F.explode(F.when(_unknown(keys), every).otherwise(F.array(F.lit(0)))))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL.

    Rows of the left side without any known key are dealt over ``UNKNOWN_PARTS`` parts and those
    of the right side copied to each, so unknown keys, often many, never meet in one task. Rows
    with some key known are spread by it and travel once; the runtime splits those that gather.
    A right join is the left join of the swapped sides, a full join see ``full_join``.
    """
    if how in ("full", "outer", "full_outer"):
        return full_join(left, right, keys)
    if how in ("right", "right_outer"):
        order = [*left.columns, *[c for c in right.columns if c not in keys]]
        return null_safe_join(right, left, keys, "left").select(*[F.col(f"`{c}`") for c in order])
    taken = [*left.columns, *right.columns]
    names = {k: unused(taken, f"_r_{i}") for i, k in enumerate(keys)}
    part, copy = unused(taken, "_part"), unused(taken, "_copy")
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(UNKNOWN_PARTS)).cast("int")
    left = left.withColumn(part, F.when(_unknown(keys), dealt).otherwise(0))
    if how in ("left_semi", "left_anti"):
        right = right.select(*keys)
    right = copied(right, keys, copy).withColumnsRenamed(names)
    meet = all_equal([(left[f"`{k}`"], right[n]) for k, n in names.items()]) & (left[part] == right[copy])
    return left.join(right, meet, how).drop(part, copy, *names.values())


def full_join(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of both sides, matched on ``keys``, NULL matching NULL.

    Both sides are tagged and stacked, and one aggregate per key, combined before the shuffle,
    counts the rows of each side and keeps one of each. Keys with one row a side at most, the
    usual case, are complete with that. Rows of keys that repeat are joined from the sides again.
    """
    rest_a, rest_b = ([c for c in d.columns if c not in keys] for d in (a, b))
    if set(rest_a) & set(rest_b):
        raise ValueError("full_join: the sides share columns besides the keys")
    names = {k: f"k{i}" for i, k in enumerate(keys)}
    columns = [F.col(f"`{k}`").alias(n) for k, n in names.items()]

    def side(df: DataFrame, rest: list[str], tag: str) -> DataFrame:
        row = F.struct(F.lit(True).alias("here"), *[F.col(f"`{c}`") for c in rest])
        return df.select(*columns, row.alias(tag))

    stacked = side(a, rest_a, "a").unionByName(side(b, rest_b, "b"), allowMissingColumns=True)
    merged = stacked.groupBy(*names.values()).agg(
        F.count("a").alias("n_a"), F.count("b").alias("n_b"), F.max("a").alias("a"), F.max("b").alias("b")
    )
    out = [F.col(n).alias(k) for k, n in names.items()]
    out += [F.col(f"{tag}.`{c}`").alias(c) for tag, rest in (("a", rest_a), ("b", rest_b)) for c in rest]
    merged = staged(merged)
    once = merged.filter("n_a <= 1 AND n_b <= 1").select(*out)
    often = merged.filter("n_a > 1 OR n_b > 1").select(*[F.col(n).alias(k) for k, n in names.items()])
    if often.isEmpty():
        return once
    a, b = (null_safe_join(d, often, keys, "left_semi") for d in (a, b))
    met = null_safe_join(a, b, keys, "left")
    alone = null_safe_join(b, a, keys, "left_anti")
    return once.unionByName(met).unionByName(alone, allowMissingColumns=True)


def key_presence(a: DataFrame, b: DataFrame, keys: list[str], in_a: str, in_b: str) -> DataFrame:
    """Keys of both sides and where each occurs, as often as a full join has them: one aggregate."""
    n_a, n_b, copy = (unused(keys, x) for x in ("_n_a", "_n_b", "_copy"))
    stacked = a.select(*keys, F.lit(1).alias(n_a), F.lit(0).alias(n_b)).unionByName(
        b.select(*keys, F.lit(0).alias(n_a), F.lit(1).alias(n_b))
    )
    counts = stacked.groupBy(*keys).agg(F.sum(n_a).alias(n_a), F.sum(n_b).alias(n_b))
    times = F.greatest(F.col(n_a), F.lit(1)) * F.greatest(F.col(n_b), F.lit(1))
    once = counts.filter(times == 1)
    # Copies of a key are counted out in a row of their own, never by an array of all of them.
    block = 1024
    blocks = F.explode(F.sequence(F.lit(0), F.floor((times - 1) / block)))
    often = counts.filter(times > 1).withColumn(copy, times).withColumn("_block", blocks).repartition(*keys, "_block")
    inside = F.least(F.lit(block), F.col(copy) - F.col("_block") * block).cast("int")
    often = often.withColumn("_one", F.explode(F.array_repeat(F.lit(0), inside)))
    sides = [(F.col(n_a) > 0).alias(in_a), (F.col(n_b) > 0).alias(in_b)]
    return once.unionByName(often.select(*counts.columns)).select(*keys, *sides)


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every column the two sides share, NULL matching NULL."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("natural_join: no shared columns")
    return null_safe_join(left, right, shared, how)


def reconcile(
    a: DataFrame, b: DataFrame, keys: list[str], in_a: str = "in_a", in_b: str = "in_b"
) -> DataFrame:
    """Rows of both sides, matched where they can be, with the sides each was found on."""
    if set(a.columns) | set(b.columns) <= set(keys):
        return key_presence(a, b, keys, in_a, in_b)
    joined = full_join(a.withColumn(in_a, F.lit(True)), b.withColumn(in_b, F.lit(True)), keys)
    return joined.fillna(False, [in_a, in_b])


def missing_from(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``a`` whose key does not occur in ``b``."""
    return null_safe_join(a, b.select(*keys), keys, "left_anti")


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values found on more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Return ``df`` or raise if a key repeats. Runs one aggregate."""
    if not key_violations(df, keys).isEmpty():
        raise ValueError(f"duplicate keys on {keys}")
    return df


def lookup(
    df: DataFrame, entries: DataFrame, key: str, value: str, order: str
) -> DataFrame:
    """Dictionary lookup: among repeated entries the one with the largest ``order`` wins.

    Entries of equal order are settled by the larger value.
    """
    last = F.max(F.struct(F.col(order).alias("order"), F.col(value).alias("value")))
    latest = entries.groupBy(key).agg(last["value"].alias(value))
    return df.join(latest, key, "left")


def restrict_to(ids: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` for the listed ids; an id without a row stays with unknown values."""
    return ids.select(key).join(df, key, "left")


def compare(
    a: DataFrame, b: DataFrame, keys: list[str], cols: list[str], suffixes=("_a", "_b")
) -> DataFrame:
    """Outer join of two systems with the compared columns of each side by side."""
    left, right = (
        d.select(*keys, *[F.col(f"`{c}`").alias(c + s) for c in cols]) for d, s in zip((a, b), suffixes)
    )
    return full_join(left, right, keys)

"""Best-fit-decreasing packing of indivisible groups into shards.

Groups are the rows of equal text. Sizes are summed per group before anything moves, then
units are packed: every group above a fixed part of a shard is a unit of its own, and the
small groups share units by hash. So a yard of ``YARD_SHARDS`` shards has a bounded number
of units, whatever the input. The units of a yard, sorted by size, enter the tightest
remaining capacity through a balanced tree.

A null text counts as the empty text. Equal texts, nulls among them, go to one shard;
repeated rows are rows of their own with a slot each. A null key is numbered like any other.
Slots are places by partition offsets, so no task sees a whole shard.
An empty table gives an empty result. Only key and text are read, so other columns cannot
clash; a group above the capacity has a shard of its own.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from milepost.operators.ranks import numbered
from milepost.session import staged

HEADER_BYTES = 16
UNITS_PER_SHARD = 256
YARD_SHARDS = 64
# Unit tables up to this number of rows are broadcast; larger ones are joined by shuffle.
BROADCAST_UNITS = 200_000
SEARCH_STEPS = 24


class FreeSpace:
    """Balanced (AA) tree of (remaining capacity, bin), smallest sufficient one first."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _skew(t):
        if t and t[1] and t[1][3] == t[3]:
            left = t[1]
            t[1], left[2] = left[2], t
            return left
        return t

    @staticmethod
    def _split(t):
        if t and t[2] and t[2][2] and t[3] == t[2][2][3]:
            right = t[2]
            t[2], right[1] = right[1], t
            right[3] += 1
            return right
        return t

    def _add(self, t, key):
        if t is None:
            return [key, None, None, 1]
        side = 1 if key < t[0] else 2
        t[side] = self._add(t[side], key)
        return self._split(self._skew(t))

    def _drop(self, t, key):
        if key != t[0]:
            side = 1 if key < t[0] else 2
            t[side] = self._drop(t[side], key)
        elif not t[1] and not t[2]:
            return None
        else:
            side, back = (2, 1) if t[2] else (1, 2)
            near = t[side]
            while near[back]:
                near = near[back]
            t[0] = near[0]
            t[side] = self._drop(t[side], near[0])
        level = min(t[1][3] if t[1] else 0, t[2][3] if t[2] else 0) + 1
        if level < t[3]:
            t[3] = level
            if t[2]:
                t[2][3] = min(t[2][3], level)
        t = self._skew(t)
        t[2] = self._skew(t[2])
        if t[2]:
            t[2][2] = self._skew(t[2][2])
        t = self._split(t)
        t[2] = self._split(t[2])
        return t

    def put(self, free: int, bin_: int) -> None:
        self.root = self._add(self.root, (free, bin_))

    def take(self, size: int):
        """Remove and return the tightest entry with room for ``size``, or None."""
        best, t = None, self.root
        while t:
            if t[0][0] >= size:
                best, t = t[0], t[1]
            else:
                t = t[2]
        if best:
            self.root = self._drop(self.root, best)
        return best


def best_fit(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of each size (given in falling order); None if more than ``most`` bins are needed."""
    space, bins, out = FreeSpace(), 0, []
    for size in sizes:
        found = space.take(size)
        if found is None:
            if most is not None and bins == most:
                return None
            found, bins = (max(capacity, size), bins), bins + 1
        out.append(found[1])
        space.put(found[0] - size, found[1])
    return out


def even_fit(sizes: list[int], bins: int) -> list[int]:
    """Bins of near equal size: the least capacity for which best fit needs ``bins`` at most.

    Sizes of a fair share or more of what is left take a bin each, so they do not raise the
    capacity of the others.
    """
    rest, own = sum(sizes), 0
    while own < len(sizes) and own < bins - 1 and sizes[own] * (bins - own) >= rest:
        rest -= sizes[own]
        own += 1
    others, left = sizes[own:], bins - own
    low = max([math.ceil(rest / left), *others[:1]])
    high, found = low, best_fit(others, low, left)
    while found is None:
        low, high = high, high + max(1, high // 16)
        found = best_fit(others, high, left)
    for _ in range(SEARCH_STEPS):
        if high - low <= max(1, low // 20_000):
            break
        middle = (low + high) // 2
        if (tried := best_fit(others, middle, left)) is None:
            low = middle
        else:
            high, found = middle, tried
    return [*range(own), *(own + b for b in found)]


def _units(rows: DataFrame, yards: int, part: float) -> DataFrame:
    """Units of every yard: (yard, unit, bytes); small groups are merged by hash."""
    groups = rows.groupBy("yard", "bucket", "digest").agg(F.sum("size").alias("bytes"))
    unit = F.when(F.col("bytes") > part, F.hex("digest")).otherwise(F.col("bucket").cast("string"))
    return groups.groupBy("yard", unit.alias("unit")).agg(F.sum("bytes").alias("bytes"))


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
    capacity: int | None = None,
) -> DataFrame:
    """One row per input row: key, size, text_crc32, shard and slot (gapless in each shard).

    Give ``shards`` for that many shards of near equal bytes, or ``capacity`` for as few
    shards as best fit needs at that size; then yards are packed independently.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = staged(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(whole) + HEADER_BYTES).cast("long").alias("size"),
            F.crc32(whole).alias("crc"),
            F.unhex(F.sha2(whole, 256)).alias("digest"),
        )
    )
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    per_yard = shards or YARD_SHARDS
    yards = 1 if shards else max(1, math.ceil(total / (capacity * YARD_SHARDS)))
    buckets = per_yard * UNITS_PER_SHARD
    part = (total / shards if shards else capacity) / UNITS_PER_SHARD
    rows = rows.withColumn("yard", F.pmod(F.xxhash64("digest"), F.lit(yards)).cast("int"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("digest", F.lit("unit")), F.lit(buckets)).cast("int"))

    def packed(units: pd.DataFrame) -> pd.DataFrame:
        units = units.sort_values(["bytes", "unit"], ascending=[False, True])
        sizes = units["bytes"].tolist()
        bins = even_fit(sizes, shards) if shards else best_fit(sizes, capacity)
        return units.assign(bin=bins)[["yard", "unit", "bin"]]

    plan = staged(
        _units(rows, yards, part).groupBy("yard").applyInPandas(packed, "yard int, unit string, bin int")
    )
    first = plan.groupBy("yard").agg((F.max("bin") + 1).alias("n"))
    before = Window.orderBy("yard").rowsBetween(Window.unboundedPreceding, -1)  # one row per yard
    first = first.select("yard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    plan = plan.join(first, "yard").select("yard", "unit", (F.col("first") + F.col("bin")).cast("int").alias("shard"))
    # A yard has no more than buckets + per_yard * UNITS_PER_SHARD units.
    small = (lambda x: F.broadcast(x)) if yards * 2 * buckets <= BROADCAST_UNITS else (lambda x: x)
    large = plan.filter(F.length("unit") == 64)
    large = large.select(F.unhex("unit").alias("digest"), F.col("shard").alias("own_shard"))
    merged = plan.filter(F.length("unit") < 64)
    merged = merged.select("yard", F.col("unit").cast("int").alias("bucket"), F.col("shard").alias("bucket_shard"))
    placed = (
        rows.join(small(large), "digest", "left")
        .join(small(merged), ["yard", "bucket"], "left")
        .withColumn("shard", F.coalesce("own_shard", "bucket_shard"))
    )
    placed = placed.select("key", "digest", "size", "crc", "shard")
    return numbered(placed, ["shard"], ["key", "digest"], "slot", "shard_rows").select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", "slot"
    )

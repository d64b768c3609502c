"""Plan of a split read: predicates on a key that cover a table once, with even numbers of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A plan is made from at most about this many key ranges, whatever the number of keys.
RANGES = 4096


def key_counts(df: DataFrame, key: str, ranges: int = RANGES) -> list[tuple[int | None, int]]:
    """(first key, rows) of ranges of equal width between the bounds, and (None, rows) of no key.

    Two small aggregates: the bounds, then the rows per range.
    """
    low, high = df.agg(F.min(key), F.max(key)).first()
    if low is None:
        return [(None, df.count())]
    width = range_width(low, high, ranges)
    place = F.floor((F.col(key) - F.lit(low)) / F.lit(width))
    rows = df.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n")).collect()  # ``ranges`` at most
    return counts_of(rows, low, width)


def range_width(low: int, high: int, ranges: int = RANGES) -> int:
    return (int(high) - int(low)) // ranges + 1


def counts_of(rows: list, low: int, width: int) -> list[tuple[int | None, int]]:
    """Rows (place, n) as (first key, n), rows without a key first."""
    counts = [(None if place is None else int(low) + int(place) * width, int(n)) for place, n in rows]
    return sorted(counts, key=lambda c: (c[0] is not None, c[0] or 0))


def bounds_query(view: str, key: str) -> str:
    """SQL that a database answers with one row, for the bounds of a key."""
    return f"SELECT MIN({key}) AS low, MAX({key}) AS high, COUNT(*) AS n FROM {view}"


def counts_query(view: str, key: str, low: int, width: int) -> str:
    """SQL that a database answers with one row a range, for the rows per range of keys."""
    place = f"FLOOR(({key} - {low}) / {width})"
    return f"SELECT {place} AS place, COUNT(*) AS n FROM {view} GROUP BY {place}"


def split_predicates(counts: list[tuple[int | None, int]], key: str, parts: int) -> list[str]:
    """Predicates that together take every row exactly once, rows without a key included.

    Ranges are joined from the lowest key while the part stays closer to an even share with
    the next range than without it, so no part exceeds the even share by more than one range.
    The first part is open below, the last above; keys that appear later than the counts have
    their place as well.
    """
    if parts < 1:
        raise ValueError("split_predicates: at least one part")
    known = [(k, n) for k, n in counts if k is not None]
    left, cuts, size = sum(n for _, n in known), [], 0
    for k, n in known:
        share = (left + size) / (parts - len(cuts))
        if size and len(cuts) < parts - 1 and size + n / 2 > share:
            cuts.append(k)
            size = 0
        size, left = size + n, left - n
    bounds = [None, *cuts, None]
    texts = []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        ends = [f"{key} >= {low}"] * (low is not None) + [f"{key} < {high}"] * (high is not None)
        texts.append(" AND ".join(ends) or f"{key} IS NOT NULL")
    return [*texts, f"{key} IS NULL"]


def read_split(df: DataFrame, predicates: list[str]) -> DataFrame:
    """The rows of ``df`` with the number of the predicate that takes each (``part``)."""
    part = F.coalesce(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)])
    return df.withColumn("part", part)

"""Choose rows per key. Everything pre-aggregates before the shuffle, so a key that
owns a large share of the rows never lands whole in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.operators.ranks import numbered, unused
from milepost.session import staged


def pick_row(
    df: DataFrame,
    keys: list[str],
    by: str,
    ties: list[str] = (),
    largest: bool = True,
    keep_unknown: bool = False,
) -> DataFrame:
    """One whole row per key: the largest (or smallest) ``by``.

    Equal rows are settled by the tie columns in the same direction, without tie columns by
    all others, so the choice never depends on the order of arrival. Rows without ``by`` are
    ignored; with ``keep_unknown`` they are taken for keys that have no others.
    """
    rest = [c for c in df.columns if c not in keys]
    known = F.col(by).isNotNull() if largest else F.col(by).isNull()
    flag = [known.alias(unused(rest, "_known"))] if keep_unknown else []
    rows = df if keep_unknown else df.filter(F.col(by).isNotNull())
    if ties:
        # The row itself, its columns in the order that decides: none of them travels twice.
        order = list(dict.fromkeys([by, *ties]))
        choose = F.max if largest else F.min
        picked = choose(F.struct(*flag, *order, *[c for c in rest if c not in order]))
    else:
        choose = F.max_by if largest else F.min_by
        picked = choose(F.struct(*rest), F.struct(*flag, by, *[c for c in rest if c != by]))
    return rows.groupBy(*keys).agg(picked.alias("_row")).select(*keys, *[F.col(f"_row.`{c}`") for c in rest])


def latest_batch(df: DataFrame, key: str, ts: str) -> DataFrame:
    """All rows that carry the newest ``ts`` of their key, ties kept."""
    newest = df.groupBy(key).agg(F.max(ts).alias(ts))
    return df.join(newest, [key, ts])


def duplicated(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def split_duplicate_ids(
    df: DataFrame, key: str, order: list[str], only, out: str = "unit_key", written: bool = False
) -> DataFrame:
    """Make repeated keys unique among the rows that satisfy ``only``: ``12_0``, ``12_1``…

    Rows of one key are numbered in the given order by partition offsets, so no task sees a
    whole hot key. A key that other rows carry as well counts as repeated even if it is chosen
    only once. Other rows keep their key and are not ordered: only their keys travel. Rows
    without a key stay, without one. The rows are read several times, from a stage table
    unless they are ``written`` already.
    """
    flag, place, size = (unused(df.columns, x) for x in ("_only", "_place", "_size"))
    chosen = F.coalesce(only, F.lit(False)) & F.col(key).isNotNull()
    tagged = df.withColumn(flag, chosen)
    tagged = tagged if written else staged(tagged)
    others = tagged.filter(~F.col(flag)).drop(flag)
    ranked = numbered(tagged.filter(flag).drop(flag), [key], list(order), place, size)
    id_text = F.col(key).cast("string")
    # A key is met by rows that are not chosen, too: one row a key says so.
    carried = others.select(key).join(tagged.filter(flag).select(key).distinct(), key, "left_semi").distinct()
    ranked = ranked.join(carried.withColumn(flag, F.lit(True)), key, "left")
    renamed = F.when(
        F.col(flag) | (F.col(size) > 1), F.concat_ws("_", id_text, F.col(place).cast("string"))
    ).otherwise(id_text)
    ranked = staged(ranked.withColumn(out, renamed).select(*df.columns, out))
    return ranked.unionByName(others.withColumn(out, id_text))

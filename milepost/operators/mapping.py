"""Column-level mapping between two table layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns that exist on one side only."""
    rows = [(c, "left_only") for c in a.columns if c not in b.columns]
    rows += [(c, "right_only") for c in b.columns if c not in a.columns]
    return a.sparkSession.createDataFrame(rows, "column string, side string")


def read_mapping(mapping: DataFrame, source: str, target: str, columns: list[str]) -> dict[str, str]:
    """Pairs of a mapping table for the given columns of a table, so one pair per column at most.

    Of several names for a column the least is taken.
    """
    known = mapping.filter(F.col(source).isin(columns) & F.col(target).isNotNull())
    pairs = known.groupBy(source).agg(F.min(target).alias(target)).collect()
    return {row[source]: row[target] for row in pairs}


def apply_mapping(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep the mapped columns that ``df`` has and give them their new names."""
    return df.select(*[F.col(c).alias(new) for c, new in mapping.items() if c in df.columns])


def route_columns(columns: list[str], tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Project every table to the listed columns it has."""
    return {
        name: df.select(*[c for c in columns if c in df.columns]) for name, df in tables.items()
    }

"""Read source views with projection and typing; write and read snapshots of them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.plans.pipelines import Snapshot
from milepost.sources.catalog import SNAPSHOT_TABLES, VIEWS
from milepost.sources.files import read_id_list
from milepost.sources.manifest import commit_tables, read_tables
from milepost.sources.splits import bounds_query, counts_of, counts_query, range_width, split_predicates

KEY = "IdeUsinaOutorga"

# Type of a column by the first three letters of its name.
PREFIX_TYPES = {"Dat": "timestamp", "Mda": "double", "Ide": "bigint"}
ISO_DATE = "yyyy-MM-dd"


def _typed(name: str, dtype: str) -> Column:
    target = PREFIX_TYPES.get(name[:3])
    col = F.col(f"`{name}`")
    if target is None or dtype == target:
        return col
    if target == "timestamp":
        # Unreadable dates become unknown; zoneless timestamps and dates stay as they are.
        if dtype in ("date", "timestamp_ntz"):
            return col
        return F.try_to_timestamp(col.cast("string")).cast("timestamp_ntz").alias(name)
    return col.cast(target).alias(name)


def apply_prefix_types(df: DataFrame) -> DataFrame:
    """Types by name prefix: dates lenient, measures double, identifiers integer."""
    return df.select(*[_typed(name, dtype) for name, dtype in df.dtypes])


def coerce_dates(df: DataFrame, fmt: str = ISO_DATE, prefix: str = "Dat") -> DataFrame:
    """Text columns of the prefix read strictly by ``fmt``; anything else becomes unknown."""
    dates = [c for c, t in df.dtypes if c.startswith(prefix) and t == "string"]
    return df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(fmt)).cast("date") for c in dates})


def scan(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Project to the listed columns and rename them."""
    return df.select(*[F.col(f"`{c}`").alias(new) for c, new in names.items()])


def read_view(
    spark: SparkSession,
    name: str,
    location: str | None = None,
    jdbc: dict[str, str] | None = None,
    parts: int = 32,
) -> DataFrame:
    """A source view with its known columns, from parquet or over JDBC.

    A view with plants is read over JDBC in ``parts`` reads of about equal size and one of the
    rows without a plant: the database counts rows per range of plants first.
    """
    columns = VIEWS[name]
    if jdbc is None:
        return spark.read.parquet(f"{location}/{name}").select(*columns)
    reader = spark.read.format("jdbc").options(**jdbc).option("dbtable", name)
    if KEY not in columns:
        return reader.load().select(*columns)
    ask = lambda text: spark.read.format("jdbc").options(**jdbc).option("query", text).load().collect()
    low, high, n = ask(bounds_query(name, KEY))[0]
    counts = [(None, n)]
    if low is not None:
        width = range_width(low, high)
        counts = counts_of(ask(counts_query(name, KEY, low, width)), low, width)
    predicates = split_predicates(counts, KEY, parts)
    rest = {k: v for k, v in jdbc.items() if k != "url"}
    return spark.read.jdbc(jdbc["url"], name, predicates=predicates, properties=rest).select(*columns)


def take_snapshot(
    spark: SparkSession, names: list[str], target: str, loaded_at: dt.datetime, **source
) -> int:
    """Copy views into typed parquet tables and publish them together; gives the generation."""
    typed = {name: apply_prefix_types(read_view(spark, name, **source)) for name in names}
    return commit_tables(spark, typed, target, loaded_at)


def read_snapshot(
    spark: SparkSession, folder: str, id_list: str | None = None, generation: int | None = None
) -> Snapshot:
    """The tables of the newest, or of the given, generation under the names the plans use."""
    pinned = read_tables(spark, folder, generation)
    tables = {
        role: scan(pinned[view], names)
        for role, (view, names) in SNAPSHOT_TABLES.items()
    }
    selected = (
        read_id_list(spark, id_list) if id_list else tables["plants"].select("plant_id").limit(0)
    )
    return Snapshot(**tables, selected=selected)

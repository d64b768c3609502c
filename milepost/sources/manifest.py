"""Snapshots as generations: tables are written aside, then published by one manifest entry.

A table of a new generation goes to a folder of its own and its rows are counted while they
are written. Only when all tables are complete, one file with one row per table is added to
the manifest, and readers that ask from then on get that generation; readers pinned to an
earlier one keep it. A run that stops in between leaves folders that no entry names. Tables
that a run does not load are carried over, so one entry always describes a whole snapshot.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "generation bigint, run string, table_name string, path string, n_rows bigint, loaded_at timestamp_ntz"
)


def manifest_path(folder: str) -> str:
    return f"{folder}/_manifest_tables"


def _entries(spark: SparkSession, folder: str) -> DataFrame | None:
    """All rows of the manifest; None before the first snapshot."""
    path = spark._jvm.org.apache.hadoop.fs.Path(manifest_path(folder))
    if not path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        return None
    return spark.read.schema(SCHEMA).parquet(manifest_path(folder))


def commit_tables(
    spark: SparkSession, tables: dict[str, DataFrame], folder: str, loaded_at: dt.datetime
) -> int:
    """Write all ``tables`` and publish them as the next generation, whose number is returned."""
    known = _entries(spark, folder)
    before = [] if known is None else _newest(known).collect()  # one row a table
    generation = max((r.generation for r in before), default=0) + 1
    run = uuid.uuid4().hex
    rows = []
    for name, df in tables.items():
        path, seen = f"{folder}/generation-{generation:06d}-{run}/{name}", Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.parquet(path)
        rows.append((generation, run, name, path, seen.get["n_rows"], loaded_at))
    rows += [(generation, run, *r[2:]) for r in before if r.table_name not in tables]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(manifest_path(folder))
    return generation


def _newest(entries: DataFrame, generation: int | None = None) -> DataFrame:
    """Rows of one generation; of two runs that published the same number, one run's rows."""
    rows = entries if generation is None else entries.filter(F.col("generation") == generation)
    pin = rows.agg(F.max(F.struct("generation", "run")).alias("pin"))
    return rows.join(F.broadcast(pin), F.struct("generation", "run") == F.col("pin"), "left_semi")


def read_manifest(spark: SparkSession, folder: str, generation: int | None = None) -> DataFrame:
    """One row per table of the newest, or of the given, generation."""
    entries = _entries(spark, folder)
    return spark.createDataFrame([], SCHEMA) if entries is None else _newest(entries, generation)


def read_tables(spark: SparkSession, folder: str, generation: int | None = None) -> dict[str, DataFrame]:
    """The tables of one generation. Their folders are fixed here, so later commits do not matter."""
    pinned = read_manifest(spark, folder, generation).select("table_name", "path").collect()
    if not pinned:
        raise ValueError(f"no such snapshot in {folder}")
    return {r.table_name: spark.read.parquet(r.path) for r in pinned}


def latest_entries(entries: DataFrame) -> DataFrame:
    """Newest load time of every table of a list of load records."""
    return entries.groupBy("table_name").agg(F.max("loaded_at").alias("loaded_at"))


def missing_tables(manifest: DataFrame, required: list[str] | DataFrame) -> DataFrame:
    """Required tables that the manifest does not have; a frame has them in ``table_name``."""
    if isinstance(required, list):
        required = manifest.sparkSession.createDataFrame([(n,) for n in required], "table_name string")
    return required.select("table_name").distinct().join(manifest, "table_name", "left_anti")


def snapshot_complete(manifest: DataFrame, required: list[str] | DataFrame) -> bool:
    return missing_tables(manifest, required).isEmpty()


def snapshot_label(manifest: DataFrame) -> DataFrame:
    """Load times as one text per table, for file names and listings."""
    return manifest.select(
        "table_name", F.date_format("loaded_at", "yyyy_MM_dd_HH_mm").alias("label")
    )

"""Tabular files: conversion to parquet, union, overlap checks, id lists."""

from __future__ import annotations

import json
import os
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SOURCE_FILE = "source_file"
_STATE = "source_state"


KINDS = {".csv": "csv", ".json": "json"}


def _origin() -> Column:
    """Path, size and time of change of the file of a row."""
    parts = {"path": "file_path", "size": "file_size", "changed": "file_modification_time"}
    return F.struct(*[F.col(f"_metadata.{c}").alias(name) for name, c in parts.items()]).alias(SOURCE_FILE)


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Path, origin (as rows name it), size and time of change of every file, none being read."""
    return spark.read.format("binaryFile").load(paths).select("path", _origin())


def read_files(spark: SparkSession, paths: list[str], schema: str | None = None) -> DataFrame:
    """All files in one read per kind, with the origin of each row in ``source_file``.

    Columns are found by name. Without a schema one is inferred over all files together.
    Csv files with their columns in several orders are read in one read per order.
    """
    kinds: dict[tuple, list[str]] = {}
    for path in paths:
        kind = KINDS.get(os.path.splitext(path)[1])
        if kind is None:
            raise ValueError(f"unsupported file type: {path}")
        heading = _first_line(spark, path) if kind == "csv" else ""
        kinds.setdefault((kind, heading), []).append(path)
    parts = []
    for (kind, _), group in kinds.items():
        reader = spark.read.options(header=True, inferSchema=schema is None, enforceSchema=False)
        parts.append(reader.format(kind).load(group).select("*", _origin()))
    if schema is None:
        return _stack(parts)
    wanted = spark.createDataFrame([], schema).schema
    return _stack([p.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in wanted], SOURCE_FILE) for p in parts])


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _first_line(spark: SparkSession, path: str) -> str:
    """The heading of a file, or of the first file of a folder, on any file system Spark reads."""
    place, fs = _file_system(spark, path)
    if fs.getFileStatus(place).isDirectory():
        inside = sorted(str(f.getPath()) for f in fs.listStatus(place))
        data = [f for f in inside if os.path.basename(f)[0] not in "._"]
        return _first_line(spark, data[0]) if data else ""
    stream = fs.open(place)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def ingest_files(
    spark: SparkSession,
    paths: list[str],
    columns: list[str] | None = None,
    parquet_dir: str | None = None,
    unique_across: list[str] = (),
    refresh: bool = False,
    schema: str | None = None,
) -> DataFrame:
    """Stack files on common columns (those of the first file), kept as parquet.

    With ``parquet_dir`` only files are read that have no copy of their present state, told by
    path, size and time of change and the wanted columns, all in one read and one write; a
    changed file is read again, an unchanged one never, unless ``refresh`` is set.
    ``unique_across`` lists columns whose values must not occur in two files.
    """
    if columns is None and schema is not None:
        columns = spark.createDataFrame([], schema).columns
    if columns is None:
        columns = [c for c in read_files(spark, paths[:1]).columns if c != SOURCE_FILE]
    if parquet_dir is None:
        rows = read_files(spark, paths, schema).select(*[F.col(f"`{c}`") for c in columns], SOURCE_FILE)
    else:
        rows = _kept_files(spark, paths, columns, parquet_dir, refresh, schema)
    names = {_shown(p): p for p in paths}
    origin = F.col(f"{SOURCE_FILE}.path")
    given = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    stacked = rows.withColumn(SOURCE_FILE, F.coalesce(given[F.regexp_replace(F.url_decode(origin), "^[a-z]+:/+", "/")], origin))
    for col in unique_across:
        assert_disjoint(stacked, col)
    return stacked


def _shown(path: str) -> str:
    """A path without its scheme, as files name their origin."""
    bare = path.split(":/", 1)[1] if ":/" in path else os.path.abspath(path)
    return "/" + bare.lstrip("/")


_COPIES = "state string, run string, schema string"


def _kept_files(
    spark: SparkSession, paths: list[str], columns: list[str], folder: str, refresh: bool, schema: str | None
) -> DataFrame:
    """The rows of all files from their parquet copies, missing copies being written first."""
    origin = [F.col(f"{SOURCE_FILE}.{x}") for x in ("path", "size", "changed")]
    facts = F.concat_ws("|", *[c.cast("string") for c in origin], F.lit(schema), *map(F.lit, columns))
    state = F.sha2(facts, 256)
    states = {r.state: r.path for r in list_files(spark, paths).select("path", state.alias("state")).collect()}
    place, fs = _file_system(spark, f"{folder}/_copies")
    kept = {}
    if fs.exists(place) and not refresh:
        listed = spark.read.schema(_COPIES).parquet(f"{folder}/_copies")
        kept = {r.state: (r.run, r.schema) for r in listed.collect() if r.state in states}
    fresh = {state: path for state, path in states.items() if state not in kept}
    if fresh:
        rows = read_files(spark, list(fresh.values()), schema)
        rows = rows.select(*[F.col(f"`{c}`") for c in columns], SOURCE_FILE)
        run = uuid.uuid4().hex
        rows.withColumn(_STATE, state).write.partitionBy(_STATE).parquet(f"{folder}/run-{run}")
        # Copies count from here on: a run that stops before leaves files that nothing names.
        made = [(state, run, rows.schema.json()) for state in fresh]
        spark.createDataFrame(made, _COPIES).coalesce(1).write.mode("append").parquet(f"{folder}/_copies")
        kept |= {state: (run, rows.schema.json()) for state in fresh}
    runs: dict[tuple, list[str]] = {}
    for state, run in kept.items():
        runs.setdefault(run, []).append(state)
    parts = []
    for (run, kind), wanted in runs.items():
        whole = StructType.fromJson(json.loads(kind)).add(_STATE, "string")
        rows = spark.read.schema(whole).parquet(f"{folder}/run-{run}")
        parts.append(rows.filter(F.col(_STATE).isin(wanted)).drop(_STATE))
    return _stack(parts)


def overlapping_values(df: DataFrame, col: str, source: str = SOURCE_FILE) -> DataFrame:
    """Values of ``col`` found in more than one file: smallest and largest file differ."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.min(source).alias("first_file"), F.max(source).alias("last_file"))
        .filter("first_file <> last_file")
    )


def assert_disjoint(df: DataFrame, col: str, source: str = SOURCE_FILE) -> DataFrame:
    clash = overlapping_values(df, col, source).head(5)
    if clash:
        values = ", ".join(str(row[col]) for row in clash)
        raise ValueError(f"column {col}: values in more than one file, e.g. {values}")
    return df


def parse_ids(lines: DataFrame, text: str = "value", out: str = "plant_id") -> DataFrame:
    """Ids of a comma-separated text, blanks and line ends ignored."""
    return (
        lines.select(F.explode(F.split(F.col(text), ",")).alias("t"))
        .select(F.trim("t").try_cast("bigint").alias(out))
        .filter(F.col(out).isNotNull())
        .distinct()
    )


def unreadable_ids(lines: DataFrame, text: str = "value") -> DataFrame:
    """Entries of a comma-separated text that are neither blank nor a number."""
    tokens = lines.select(F.explode(F.split(F.col(text), ",")).alias("t")).select(F.trim("t").alias("token"))
    return tokens.filter((F.col("token") != "") & F.col("token").try_cast("bigint").isNull()).distinct()


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a text file; entries that are no numbers raise an error that names some of them."""
    lines = spark.read.text(path)
    wrong = [r.token for r in unreadable_ids(lines).sort("token").head(5)]
    if wrong:
        raise ValueError(f"{path}: not an id: {', '.join(wrong)}")
    return parse_ids(lines)

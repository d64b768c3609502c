"""Session settings, shared scratch tables and segment tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A plant may own a large share of all units: let the runtime re-plan split
    # its partition even when that costs one more exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Only small sides are broadcast, by their measured size: a broadcast of plants or units
    # would leave the work to as few tasks as the other side has files.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "2m",
    # Small partitions are merged up to this size only, which bounds what a task holds in memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.codegen.hugeMethodLimit": "65535",
}

_DROP_SHUFFLE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The stage tables of each open ``temporary_stages`` by folder, the innermost last.
_TEMPORARY: ContextVar[tuple[dict[str, DataFrame], ...]] = ContextVar("temporary", default=())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans rely on to an existing session."""
    for key, value in _RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "milepost", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for stage tables: what ``spark.checkpoint.dir`` names.

    Unset, it is made only for a session whose driver and executors are one process, as in
    tests; on a cluster a folder of one machine would be of no use, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="milepost-"))
        folder = context.getCheckpointDir()
    return folder


def _stage_folder(spark: SparkSession) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/milepost-{spark.sparkContext.applicationId}"


def stage_folder(spark: SparkSession) -> str:
    """A new shared folder that ``drop_stages`` removes."""
    return f"{_stage_folder(spark)}/{uuid.uuid4().hex}"


@contextmanager
def held(spark: SparkSession, **settings: str) -> Iterator[None]:
    """``settings`` hold while tables are written, and what their writing shuffled is dropped.

    Once a table is there, its shuffle files are of no use.
    """
    settings = {_DROP_SHUFFLE: "true"} | settings
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def staged(df: DataFrame, **settings: str) -> DataFrame:
    """Write ``df`` as a parquet stage table in the shared folder and read it back.

    Used where one result feeds several later passes. Unlike a cached block the
    table survives executor loss, and later passes read only their columns. ``settings`` hold
    while it is written.
    """
    spark, path = df.sparkSession, stage_folder(df.sparkSession)
    with held(spark, **settings):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if within := _TEMPORARY.get():
        within[-1][path] = table
    return table


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Stage tables written inside are removed at the end, so a long run holds few at a time.

    Gives a function that exempts a stage table and returns it; the block around this one, if
    there is any, owns it then. What else is used afterwards must not read a removed table.
    """
    around, own = _TEMPORARY.get(), {}

    def kept(table: DataFrame) -> DataFrame:
        path = next((path for path, x in own.items() if x is table), None)
        if path is None:
            raise ValueError("only a stage table written inside can be kept")
        del own[path]
        if around:
            around[-1][path] = table
        return table

    token = _TEMPORARY.set((*around, own))
    try:
        yield kept
    finally:
        _TEMPORARY.reset(token)
        for path in own:
            _remove(spark, path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def drop_stages(spark: SparkSession) -> None:
    """Remove the stage tables of this application, once its results are written."""
    _remove(spark, _stage_folder(spark))


class SmallTable:
    """A segment table, computed once into a stage table because several passes read it.

    ``join`` is the same plan for every size: whether the table is broadcast is decided by
    the measured size of what was written, and a hot segment is split by the runtime.
    """

    def __init__(self, df: DataFrame):
        self.df = staged(df)

    def derive(self, df: DataFrame) -> SmallTable:
        """A projection or filter of this table."""
        table = SmallTable.__new__(SmallTable)
        table.df = df
        return table

    def join(self, big: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
        """Join ``big`` to this table on ``keys``."""
        if how not in ("left", "inner"):
            raise ValueError("a segment table is joined to rows by left or inner join")
        return big.join(self.df, keys, how)

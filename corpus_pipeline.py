"""Training-data pipeline over ``documents``: five stages, each one operator.

Each stage is written as Parquet and reread before the next one runs, and works on all rows
its predecessor kept. Rows with nulls, empty texts and repeated rows pass like others: the
classifier judges an empty text by its padding, of repeated rows one stays. Further columns
of the input are kept up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.llm import byte_bpe, icws_dedup, quality_cnn, secret_scan, simhash_decontam
from milepost.llm.common import table, tune
from milepost.session import staged

# Decisions on up to this number of texts are broadcast, more are joined by shuffle.
BROADCAST_ROWS = 200_000


def unused(docs: DataFrame, name: str) -> str:
    """A column name that the input does not have."""
    while name in docs.columns:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the convolutional classifier rejects go."""
    tune(spark)
    net = quality_cnn.train(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "_score")
    return quality_cnn.score(docs, net, into=score).filter(F.col(score) >= 0.5).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, that of the least doc_id."""
    tune(spark)
    # This stage has many joins one after the other: their sides are not gathered on the driver.
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "2m")
    classes = icws_dedup.near_duplicates(docs)
    # The row that stays is one of the least key; of rows with that key, one of the least digest.
    kept = classes.filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = staged(kept.groupBy("class_digest").agg(F.min("digest").alias("digest"), F.min("doc_id").alias("id")))
    rows = docs.select(F.struct("*").alias("row"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"))
    rows = rows.withColumn("id", F.col("row.doc_id"))
    marked = rows.join(
        kept.select(F.col("digest").alias("d"), F.col("id").alias("i")),
        (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("i")),
        "left_semi",
    )
    # Repeated rows are equal in key and text: one of them stays.
    return marked.groupBy("digest").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window similar to a benchmark item go."""
    tune(spark)
    row = unused(docs, "_row")
    inner = docs.withColumn(row, F.md5(F.coalesce("text", F.lit(""))))
    found = simhash_decontam.find(inner, table(spark, sf_dir, "benchmark"), key=row)
    found = staged(found.select(F.col("key").alias(row)).distinct())
    few = found.count() <= BROADCAST_ROWS
    return inner.join(F.broadcast(found) if few else found, row, "left_anti").select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; n_chars, where there is one, follows."""
    tune(spark)
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document, checked by decoding them again."""
    tune(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scan", secrets),
    ("byte-level BPE", encoding),
]

# Neither the network, nor the sampling, nor the forest can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole table ``documents``."""
    docs = table(tune(spark), sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs

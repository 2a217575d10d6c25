"""A corpus made ready for training: five stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import length_packing, quality_outliers, simhash_dedup, source_mixing, substring_dedup
from starloom.session import write_through

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_outliers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust outlier test reject go."""
    return quality_outliers.judged(docs, keep=COLUMNS).filter("kept").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each group stays."""
    return simhash_dedup.one_of_each(docs).select(*COLUMNS)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out; a text that loses nothing stays as it is."""
    out = substring_dedup.remove_repeated_windows(docs, carry=COLUMNS[1:])
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).withColumn("text", text).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    out = source_mixing.mix(docs, carry=COLUMNS[1:])
    copies = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return out.filter("copies > 0").withColumn("copy", F.explode(copies)).select(*COLUMNS)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document stands in the batches."""
    return length_packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", reject_outliers),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", remove_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

#: SimHash, the covariance estimates and the dynamic programs cannot be stated in SQL; tests hold brute force against them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_through(stage(spark, docs, sf_dir), name)
    return docs

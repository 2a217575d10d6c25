"""Keep-first deduplication and duplicate reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in columns]


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in ``order_by``.

    Spark limits each group to one row before the shuffle, so a hot key sends
    at most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*_order(order_by))
    return df.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count and surplus rows."""
    return duplicates_counted(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")))


def duplicates_counted(counted: DataFrame) -> DataFrame:
    """The same from the ``row_count`` of every key."""
    return counted.where("row_count > 1").withColumn("surplus", F.col("row_count") - 1)


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: duplicated keys, rows that share a key, and surplus rows."""
    return summary_of(duplicate_keys(df, keys))


def summary_of(duplicates: DataFrame) -> DataFrame:
    return duplicates.agg(
        F.count(F.lit(1)).alias("duplicated_keys"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_sharing_a_key"),
        F.coalesce(F.sum("surplus"), F.lit(0)).alias("surplus_rows"),
    )

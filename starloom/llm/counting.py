"""Sizes of texts, and numbering of rows inside large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT = 256  # rows of a group that are put in order together


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def seeded(key: Column, seed: int) -> Column:
    return F.xxhash64(key, F.lit(seed))


def with_slot(rows: DataFrame, key: str, size: str, seed: int) -> DataFrame:
    """Adds ``draw``, a seeded number, and ``slot``: groups of ``size`` rows are dealt over slots by it."""
    slots = F.greatest(F.lit(1).cast("long"), F.ceil(F.col(size) / SLOT))
    return rows.withColumn("draw", seeded(F.col(key), seed)).withColumn("slot", F.pmod(F.col("draw"), slots))


def slots_before(counted: DataFrame, groups: list[str]) -> DataFrame:
    """Adds ``before``, the rows in the earlier slots of the group, to counted slots (column ``held``)."""
    w = Window.partitionBy(*groups).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("before", F.coalesce(F.sum("held").over(w), F.lit(0)).cast("long"))


def place_in_slot(groups: list[str], key: str) -> Column:
    return F.row_number().over(Window.partitionBy(*groups, "slot").orderBy("draw", key)).cast("long")

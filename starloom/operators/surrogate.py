"""Generated keys for dimension and fact rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_through

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def assign_keys(df: DataFrame, key: str, order_by: Sequence[str], start: int = 1) -> DataFrame:
    """Dense keys ``start, start+1, ...`` in the order of ``order_by``.

    Equal to a global ``row_number`` without its single task: rows are range
    partitioned and sorted, then written once with their partition and position.
    Every partition's first key follows from the row counts of the partitions
    before it, one number per partition.  The written table freezes positions,
    so a lost executor cannot renumber rows.  A hash of the whole row breaks
    ties, which also splits a hot value of ``order_by`` over partitions.
    """
    order = [F.col(c).asc_nulls_first() for c in order_by]
    placed = (
        df.withColumn("_tie", F.xxhash64(*df.columns))
        .repartitionByRange(*order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND((1 << _POSITION_BITS) - 1))
        .drop("_tie")
    )
    written = write_through(placed, f"keys-{key}")
    sizes = {r["_part"]: r["n"] for r in written.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [sizes.get(i, 0) for i in range(max(sizes, default=-1) + 1)]
    firsts = [start + before for before in accumulate(counts, initial=0)]
    first = F.get(F.lit(firsts).cast("array<bigint>"), F.col("_part"))
    return written.select((first + F.col("_pos")).alias(key), *df.columns)


def unique_row_keys(df: DataFrame, key: str, start: int = 1) -> DataFrame:
    """Unique, gapped keys without a shuffle, for fact rows.

    Partition number and row position make the key, so only the write that
    stores the rows fixes them; read them back from the stored table.
    """
    return df.select((F.monotonically_increasing_id() + F.lit(start).cast("bigint")).alias(key), *df.columns)

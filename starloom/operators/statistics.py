"""Match statistics of lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Fixed value: a lookup that misses more than this share of its rows is suspicious.
HIGH_MISS_SHARE = 0.1


def severity(rows: Column, unmatched: Column) -> Column:
    """``error`` when nothing matched, ``warning`` above the miss share, else ``ok``."""
    return (
        F.when((unmatched > 0) & (unmatched == rows), "error")
        .when(unmatched > rows * HIGH_MISS_SHARE, "warning")
        .otherwise("ok")
    )


def match_statistics(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per resolved key: rows, matched, unmatched, percent and severity.

    All keys are counted in one pass over the resolved frame.
    """
    counted = df.agg(F.count(F.lit(1)).alias("total_rows"), *[F.count(k).alias(k) for k in keys])
    per_key = counted.select(
        "total_rows",
        F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("matched")) for k in keys])).alias("s"),
    ).select(F.col("s.key").alias("lookup"), "total_rows", F.col("s.matched").alias("matched"))
    unmatched = F.col("total_rows") - F.col("matched")
    return per_key.select(
        "lookup",
        "total_rows",
        "matched",
        unmatched.alias("unmatched"),
        F.when(F.col("total_rows") > 0, F.col("matched") * 100.0 / F.col("total_rows"))
        .otherwise(F.lit(0.0))
        .alias("match_percent"),
        severity(F.col("total_rows"), unmatched).alias("severity"),
    )


def observe_matches(
    df: DataFrame, keys: Sequence[str], observation: Observation, critical: Sequence[str] = ()
) -> DataFrame:
    """Count rows, matches and rows that lack a ``critical`` key while another action runs the plan.

    Place it on the finished rows, after every lookup and every exchange, so the
    counts belong to the stage that writes and are exact even if an earlier stage
    is rerun.
    """
    counts = [F.count(F.lit(1)).alias("total_rows"), *[F.count(k).alias(k) for k in keys]]
    if critical:
        lacking = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in critical])
        counts.append(F.count_if(lacking).alias("dropped_rows"))
    return df.observe(observation, *counts)

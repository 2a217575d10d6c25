"""Rows of history tables that are current or latest, and localised text."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def current_rows(df: DataFrame, end: str, as_of: datetime.date | Column | None = None) -> DataFrame:
    """Rows still valid on ``as_of`` (today by default); the end day is exclusive."""
    if as_of is None:
        as_of = F.current_date()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of)
    return df.where(F.col(end).isNull() | (F.col(end) > as_of))


def latest_rows(df: DataFrame, keys: Sequence[str], moment: str) -> DataFrame:
    """Rows that carry the latest ``moment`` of their key; ties keep every row.

    The maximum is pre-aggregated per task, then joined back on key and moment.
    Unlike a ranking window, no group has to pass through a single task: the
    join spreads a hot key over its moments and AQE splits what is left.
    """
    peak = df.groupBy(*keys).agg(F.max(moment).alias(moment))
    return df.join(peak, [*keys, moment], "left_semi")


def preferred_text(
    links: DataFrame,
    texts: DataFrame,
    group: str,
    text_id: str,
    language: str,
    body: str,
    preferred: str = "en",
) -> DataFrame:
    """One text per group: the preferred language, else any language.

    A group that has a link in the preferred language never falls back, even
    when that link leads to no text.  "First" means the lowest text id.  Only
    ids are aggregated; text bodies are fetched for the winners alone.  Text ids
    are unique.
    """
    known = texts.select(text_id).withColumn("_known", F.lit(True))
    is_preferred = F.col(language) == preferred
    winners = (
        links.select(group, text_id, language)
        .join(known, text_id, "left")
        .groupBy(group)
        .agg(
            F.min(F.when(is_preferred & F.col("_known"), F.col(text_id))).alias("_preferred"),
            F.min(F.when(F.col("_known"), F.col(text_id))).alias("_any"),
            F.max(F.coalesce(is_preferred, F.lit(False))).alias("_has_preferred"),
        )
        .select(group, F.when(F.col("_has_preferred"), F.col("_preferred")).otherwise(F.col("_any")).alias(text_id))
        .where(F.col(text_id).isNotNull())
    )
    return winners.join(texts.select(text_id, body), text_id).select(group, body)

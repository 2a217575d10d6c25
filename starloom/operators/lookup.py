"""Joins that resolve business keys against dimensions.

Hot keys: AQE splits a hot key of one join side into many tasks, but only where
both sides come straight from a shuffle made for that join.  A side that was
grouped by the join key would be reused as it is partitioned, and the hot key
would stay in one task.  The helpers here group by a hash besides the key, so
the small grouped side is shuffled once more and the split stays possible.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _need(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{what} lacks {missing}; it has {df.columns}")


def _alike(left: T.DataType, right: T.DataType) -> bool:
    return left == right or (isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType))


def _spread(*columns: str) -> Column:
    return F.xxhash64(*columns).alias("_spread")


def key_map(dim: DataFrame, alternate_key: str | Sequence[str], surrogate_key: str) -> DataFrame:
    """Alternate key -> surrogate key; a duplicated alternate key keeps its lowest key.

    A plain hash aggregate of narrow columns: duplicates combine before the shuffle.
    """
    keys = [alternate_key] if isinstance(alternate_key, str) else list(alternate_key)
    return dim.dropna(subset=keys).groupBy(*keys, _spread(*keys)).agg(F.min(surrogate_key).alias(surrogate_key)).drop("_spread")


def distinct_keys(df: DataFrame, column: str, name: str) -> DataFrame:
    """The non-null values of a column, once each."""
    values = df.select(F.col(column).alias(name)).dropna()
    return values.groupBy(name, _spread(name)).agg(F.lit(True).alias("_found")).select(name)


def join_unique(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join against a side with unique keys that is already partitioned by them.

    Joining on a hash as well gives both sides a shuffle of their own, at the
    price of moving the right side once more.
    """
    on = list(on)
    return (
        left.withColumn("_spread", F.xxhash64(*on))
        .join(right.withColumn("_spread", F.xxhash64(*on)), [*on, "_spread"], how)
        .drop("_spread")
    )


def _once(df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.groupBy(*on, _spread(*on)).agg(F.lit(True).alias("_found")).select(*on)


def join_every(left: DataFrame, right: DataFrame, on: Sequence[str], keys: DataFrame) -> DataFrame:
    """Left join against a side that may hold many rows of one key.

    AQE never splits the right side of a left join.  So the keys that the right
    side lacks are given a row without values, and an inner join, which splits on
    both sides, finds the same rows.  ``keys`` holds at least the keys of ``left``
    and should be cheap to read.  Null keys match nothing and keep their rows.
    Keys are texts or whole numbers, these of any width on either side.
    """
    on = list(on)
    held = right.dropna(subset=on)
    lacking = _once(keys.select(*on), on).join(_once(held.select(*on), on), on, "left_anti")
    whole = held.unionByName(lacking, allowMissingColumns=True)
    whole = whole.withColumnsRenamed({c: f"_{c}" for c in on}).withColumn("_of_right", F.xxhash64(*[F.col(f"_{c}").cast("string") for c in on]))
    same = F.col("_spread") == F.col("_of_right")
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = left.withColumn("_spread", F.xxhash64(*[F.col(c).cast("string") for c in on])).join(whole, same, "inner")
    return joined.drop("_spread", "_of_right", *[f"_{c}" for c in on])


def lookup_key(
    df: DataFrame,
    dim: DataFrame,
    left_key: str,
    alternate_key: str,
    surrogate_key: str,
) -> DataFrame:
    """Left join that adds ``surrogate_key`` and drops the alternate key.

    Row count never changes.  Null business keys never match.  Whole numbers
    compare as numbers; keys of unlike types compare as text.
    """
    _need(df, [left_key], "input")
    _need(dim, [alternate_key, surrogate_key], "dimension")
    if surrogate_key in df.columns:
        raise ValueError(f"input already has {surrogate_key}")
    keys = key_map(dim, alternate_key, surrogate_key).withColumnRenamed(alternate_key, "_alternate")
    left, right = F.col(left_key), F.col("_alternate")
    if not _alike(df.schema[left_key].dataType, dim.schema[alternate_key].dataType):
        left, right = left.cast("string"), right.cast("string")
    return df.join(keys, left == right, "left").drop("_alternate", alternate_key)


def lookup_date(df: DataFrame, calendar: DataFrame, key_column: str, final_name: str | None = None) -> DataFrame:
    """Keep a date key only where the calendar has it, else null."""
    days = distinct_keys(calendar, "date_key", "_day")
    found = df.join(days, F.col(key_column) == F.col("_day"), "left")
    name = final_name or key_column
    return found.drop(key_column).withColumnRenamed("_day", name)


def lookup_with_default(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    surrogate_key: str,
    default: int | None,
    unknown: str = "Unknown",
) -> DataFrame:
    """Left join on a filled text column; a miss takes the ``default`` key.

    Where several members share the value, the one with the lowest key counts.
    """
    _need(df, [on], "input")
    _need(dim, [on, surrogate_key], "dimension")
    filled = df.withColumn(on, F.coalesce(F.col(on), F.lit(unknown)))
    members = key_map(dim.withColumn(on, F.coalesce(F.col(on), F.lit(unknown))), on, surrogate_key)
    found = filled.join(members, on, "left")
    if default is None:
        return found
    return found.withColumn(surrogate_key, F.coalesce(F.col(surrogate_key), F.lit(default).cast("bigint")))


def lookup_composite(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    surrogate_key: str,
    default: int | None = None,
    unknown: str = "Unknown",
    fan_out: bool = False,
) -> DataFrame:
    """Left join on several text columns, null parts compared as ``unknown``.

    One member per key combination (the lowest key) unless ``fan_out`` asks for
    every member.
    """
    on = list(on)
    _need(df, on, "input")
    _need(dim, [*on, surrogate_key], "dimension")
    fill = {c: F.coalesce(F.col(c), F.lit(unknown)) for c in on}
    members = dim.withColumns(fill)
    if fan_out:
        members = members.select(*on, surrogate_key).distinct()  # distinct on more than the join key
        found = join_every(df.withColumns(fill), members, on, df.withColumns(fill))
    else:
        found = df.withColumns(fill).join(key_map(members, on, surrogate_key), on, "left")
    if default is None:
        return found
    return found.withColumn(surrogate_key, F.coalesce(F.col(surrogate_key), F.lit(default).cast("bigint")))


def with_match_marker(df: DataFrame, dim: DataFrame, on: str, marker: str = "is_matched") -> DataFrame:
    """Left join against a dimension key with a boolean match column."""
    keys = distinct_keys(dim, on, on).withColumn(marker, F.lit(True))
    return df.join(keys, on, "left").withColumn(marker, F.coalesce(F.col(marker), F.lit(False)))


# Which sides of a join must hold each key once.
_UNIQUE_SIDES = {"m:1": ("right",), "1:m": ("left",), "1:1": ("left", "right"), "m:m": ()}


def validated_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    validate: str = "m:1",
) -> DataFrame:
    """Equi-join that fails when a "one" side repeats a key."""
    if validate not in _UNIQUE_SIDES:
        raise ValueError(f"validate must be one of {list(_UNIQUE_SIDES)}")
    on = list(on)
    for side, frame in (("left", left), ("right", right)):
        if side in _UNIQUE_SIDES[validate]:
            repeated = frame.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
            example = repeated.first()
            if example is not None:
                raise ValueError(f"{side} side repeats {on} = {list(example)[:-1]}, join is not {validate}")
    return left.join(right, on, how)


def orphans(child: DataFrame, parent: DataFrame, column: str, parent_key: str) -> DataFrame:
    """Rows whose non-null key has no parent."""
    keys = distinct_keys(parent, parent_key, "_parent")
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_parent"), "left_anti")


def resolve(df: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Fold :func:`lookup_key` over ``(dimension, alternate key, surrogate key)``."""
    for dim, alternate_key, surrogate_key in lookups:
        df = lookup_key(df, dims[dim], alternate_key, alternate_key, surrogate_key)
    return df

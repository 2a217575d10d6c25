"""Business keys, date keys and null filling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The business keys that are compared as text.
TEXT_KEYS = [
    "product_alternate_key",
    "customer_alternate_key",
    "promotion_alternate_key",
    "currency_alternate_key",
    "sales_territory_alternate_key",
    "reseller_alternate_key",
    "employee_alternate_key",
]

# Every character that counts as blank, not only the space.
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def trimmed_text(column: str | Column) -> Column:
    """The key as text without surrounding blanks; null becomes empty text."""
    value = F.col(column) if isinstance(column, str) else column
    return F.btrim(F.coalesce(value.cast("string"), F.lit("")), F.lit(_BLANKS))


def normalize_key(df: DataFrame, column: str) -> DataFrame:
    """Apply :func:`trimmed_text` in place; a frame without the column is left alone."""
    return df.withColumn(column, trimmed_text(column)) if column in df.columns else df


def _as_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    changes = {c: F.col(c).cast("string") for c in columns}
    return df.withColumns(changes) if changes else df


def text_keys(df: DataFrame) -> DataFrame:
    """Cast the listed business keys to text; null stays null."""
    return _as_text(df, [c for c in TEXT_KEYS if c in df.columns])


def text_alternate_keys(df: DataFrame) -> DataFrame:
    """Cast every column named like an alternate key to text; null stays null."""
    return _as_text(df, [c for c in df.columns if "alternate_key" in c])


def date_key(value: Column, dtype: T.DataType | None = None) -> Column:
    """``yyyyMMdd`` as an int; null or unreadable dates give null."""
    if isinstance(dtype, T.StringType):
        value = value.try_cast("timestamp_ntz")
    return (F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)).cast("int")


def add_date_keys(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add a date key per ``{date column: key column}``; absent dates are skipped."""
    changes = {
        key: date_key(F.col(date), df.schema[date].dataType)
        for date, key in columns.items()
        if date in df.columns
    }
    return df.withColumns(changes) if changes else df


def whole_number(value: Column, dtype: T.DataType) -> Column:
    """Coerce to bigint; anything that is not a whole number becomes null."""
    if isinstance(dtype, T.IntegralType):
        return value.cast("bigint")
    as_double = value.try_cast("double")
    from_double = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
    if isinstance(dtype, T.StringType):
        return F.coalesce(value.try_cast("bigint"), from_double)
    return from_double


def coerce_whole_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    changes = {c: whole_number(F.col(c), df.schema[c].dataType) for c in columns if c in df.columns}
    return df.withColumns(changes) if changes else df


def fill_missing(df: DataFrame, columns: Iterable[str], value: object) -> DataFrame:
    """Replace null by a constant in the columns that exist."""
    changes = {c: F.coalesce(F.col(c), F.lit(value)) for c in columns if c in df.columns}
    return df.withColumns(changes) if changes else df


def composite_key(*columns: str, separator: str = "_") -> Column:
    """Join several columns into one text key; any null part makes the key null."""
    parts = [F.col(c).cast("string") for c in columns]
    pieces = [parts[0]] + [x for p in parts[1:] for x in (F.lit(separator), p)]
    return F.concat(*pieces)

"""Named source tables as lazy DataFrames.

A source maps ``"Schema.Table"`` names to DataFrames.  Relational work is left
to Spark: base tables are scanned with the columns and filters a plan needs,
which Parquet and JDBC readers both receive from Catalyst.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


class Source(Protocol):
    spark: SparkSession

    def table(self, name: str) -> DataFrame: ...


class FrameSource:
    """Tables given as DataFrames, or as functions that build them on demand."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self.spark = spark
        self._tables = dict(tables)

    @property
    def names(self) -> list[str]:
        return list(self._tables)

    def table(self, name: str) -> DataFrame:
        found = self._tables[name]
        return found() if callable(found) else found


class ParquetSource:
    """One Parquet folder per table below ``root``: ``<root>/<Schema.Table>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")


class CatalogSource:
    """Tables of the session catalog; ``Schema.Table`` is used as it stands."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def table(self, name: str) -> DataFrame:
        return self.spark.read.table(name)


class JdbcSource:
    """Tables of a remote database.

    ``splits`` gives large tables ``(column, lower, upper, partitions)`` so they
    are read by many tasks; a table without an entry is read by one.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str] | None = None,
        splits: Mapping[str, tuple[str, object, object, int]] | None = None,
        fetch_size: int = 10_000,
        small: Sequence[str] = (),
    ):
        self.spark = spark
        self.url = url
        self.properties = dict(properties or {})
        self.splits = dict(splits or {})
        self.fetch_size = fetch_size
        self.small = frozenset(small)

    def _connection(self) -> dict[str, str]:
        return {"url": self.url, "fetchsize": str(self.fetch_size), **self.properties}

    def options(self, name: str) -> dict[str, str]:
        if name not in self.splits and name not in self.small:
            raise ValueError(f"{name} would be read by one task: give its split, or name it as small")
        options = {**self._connection(), "dbtable": name}
        if name in self.splits:
            column, lower, upper, partitions = self.splits[name]
            options |= {
                "partitionColumn": column,
                "lowerBound": str(lower),
                "upperBound": str(upper),
                "numPartitions": str(partitions),
            }
        return options

    def table(self, name: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options(name)).load()

    def query(self, sql: str) -> DataFrame:
        """Rows of a statement the database runs itself."""
        return self.spark.read.format("jdbc").options(**self._connection(), query=sql).load()


def read_tables(source: Source, names: Sequence[str]) -> list[DataFrame]:
    """Several tables, in the order asked for."""
    return [source.table(name) for name in names]

"""The target database: schema creation, load modes and read-back."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..model import DIMENSIONS, FACTS, LOOKUP_COLUMNS, TABLES, Table, conform, dependants_of, load_order
from ..operators.integrity import column_rule_report
from ..operators.statistics import observe_matches
from ..operators.surrogate import assign_keys, unique_row_keys
from ..session import passing_stages, write_through
from .dimensions import build_dimension
from .facts import FACT_PLANS, drop_incomplete

log = logging.getLogger(__name__)

CONCURRENT_LOADS = 8  # independent tables written at the same time


class ConstraintError(ValueError):
    """Rows break a rule of the table they are loaded into."""


class Warehouse:
    """Parquet tables of one Spark database.

    ``location`` is where the database keeps its files; on a cluster it must be
    shared storage (the default is the session's warehouse folder).
    ``partition_facts_by`` stores facts in folders per value of that column.
    ``sort_facts_by`` orders the rows inside each written file, so that readers
    skip parts of files by the least and greatest values Parquet keeps of them.
    """

    def __init__(
        self,
        spark: SparkSession,
        database: str = "dw",
        location: str | None = None,
        partition_facts_by: str | None = None,
        sort_facts_by: Sequence[str] = (),
    ):
        self.spark = spark
        self.database = database
        self.location = location
        self.partition_facts_by = partition_facts_by
        self.sort_facts_by = tuple(sort_facts_by)

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    # -- schema ---------------------------------------------------------

    def create(self) -> dict[str, str]:
        """Create the database and its tables; a failure is reported per table."""
        place = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{place}")
        status = {}
        for table in TABLES.values():
            try:
                self._create_table(table)
                status[table.name] = "ok"
            except Exception as error:  # one bad table must not stop the others
                log.warning("could not create %s: %s", table.name, error)
                status[table.name] = f"failed: {error}"
        return status

    def _create_table(self, table: Table) -> None:
        columns = ", ".join(f"{name} {kind}" for name, kind in table.column_types.items())
        split = f" PARTITIONED BY ({self.partition_facts_by})" if table.is_fact and self.partition_facts_by else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table.name)} ({columns}) USING parquet{split}")

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")

    # -- reading --------------------------------------------------------

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        """A loaded table; a missing one reads as empty."""
        names = list(TABLES[table].column_types)
        try:
            found = self.spark.read.table(self.name(table))
            return found if found.columns == names else found.select(*names)
        except AnalysisException:
            if self.exists(table):
                raise
            log.warning("%s does not exist", self.name(table))
            return self.spark.createDataFrame([], TABLES[table].schema)

    def tables(self) -> Mapping[str, DataFrame]:
        """All target tables by name, each read when it is asked for."""
        return _LoadedTables(self)

    def count(self, table: str) -> int:
        return self.read(table).count()

    # -- statistics -------------------------------------------------------

    def analyze(self, *tables: str) -> list[str]:
        """Row counts of tables, and statistics of their keys and lookup columns, for the optimizer.

        Without names every table that exists is analyzed, in one pass each; returns their names.
        Loading rows makes Spark drop the statistics of a table.
        """
        names = [t for t in tables or TABLES if self.exists(t)]

        def analyze_one(name: str) -> None:
            columns = ", ".join([TABLES[name].key, *LOOKUP_COLUMNS.get(name, ())])
            self.spark.sql(f"ANALYZE TABLE {self.name(name)} COMPUTE STATISTICS FOR COLUMNS {columns}")

        self._side_by_side(names, analyze_one)
        return names

    def lookup_statistics(self) -> DataFrame:
        """``table_name, column_name, distinct_values, null_values, least, greatest`` of analyzed lookup columns.

        Distinct values are an estimate.  A column without statistics has nulls.
        """
        rows = []
        for table, columns in LOOKUP_COLUMNS.items():
            for column in columns if self.exists(table) else ():
                told = self.spark.sql(f"DESCRIBE EXTENDED {self.name(table)} {column}").collect()
                known = {r["info_name"]: int(r["info_value"]) for r in told if (r["info_value"] or "").lstrip("-").isdigit()}
                rows.append((table, column, *(known.get(k) for k in ("distinct_count", "num_nulls", "min", "max"))))
        return self.spark.createDataFrame(
            rows,
            "table_name string, column_name string, distinct_values bigint, null_values bigint, least bigint, greatest bigint",
        )

    # -- writing --------------------------------------------------------

    def truncate(self, *tables: str) -> list[str]:
        """Empty tables and every table that refers to them; returns their names."""
        listed = dict.fromkeys(t for table in tables for t in (table, *dependants_of(table)))
        emptied = [t for t in listed if self.exists(t)]
        self._side_by_side(emptied, lambda name: self.spark.sql(f"TRUNCATE TABLE {self.name(name)}"))
        return emptied

    def append(
        self,
        table: str,
        df: DataFrame,
        strict: bool = False,
        into_empty: bool = False,
        only_new: bool = False,
        dealt: bool = False,
    ) -> int:
        """Append rows and return how many were written.

        Generated keys continue after the greatest existing key.  A row whose
        given key or unique columns already exist is an error; rows are never
        updated.  ``only_new`` leaves out rows whose business key is stored instead
        of refusing them.  ``strict`` also refuses null or over-long values.  Looking
        at existing rows is skipped when the table is known to be empty.  ``dealt``
        says that the rows are spread for the write already.  Staged rows are removed
        once they are stored or refused.
        """
        with passing_stages(self.spark):
            return self._append(TABLES[table], df, strict, into_empty, only_new, dealt)

    def _append(
        self, spec: Table, df: DataFrame, strict: bool, into_empty: bool, only_new: bool, dealt: bool
    ) -> int:
        table = spec.name
        ready = conform(df, spec)
        given = self._given_keys(spec) if not into_empty else []
        if only_new and not into_empty:
            ready = self._not_stored(ready, spec)
        if strict or given or not spec.generated:
            # Checked rows are written first, so that what was checked is what is loaded.
            ready = write_through(ready, f"load-{table}")
        if strict:
            self._refuse_violations(ready, spec)
        if not spec.generated:
            self._refuse_repeats(ready, spec)
        for keys in given:
            if not only_new or tuple(keys) != spec.business_key:
                self._refuse_conflicts(ready, spec, keys)
        start = 1 if into_empty else self._next_key(spec)
        ready = self._with_keys(ready, spec, start, dealt)
        if spec.is_fact and self.sort_facts_by:
            # Rows of one folder stay together, so that Spark does not sort them again by it.
            folder = [self.partition_facts_by] if self.partition_facts_by else []
            ready = ready.sortWithinPartitions(*dict.fromkeys([*folder, *self.sort_facts_by]))
        rows = Observation()
        target = self.spark.read.table(self.name(table)).columns
        ready.observe(rows, F.count(F.lit(1)).alias("n")).select(*target).write.insertInto(self.name(table))
        written = rows.get["n"]
        if written == 0:
            log.warning("%s: nothing to load", table)
        else:
            log.info("%s: %d rows loaded", table, written)
        return written

    def _next_key(self, spec: Table) -> int:
        if not spec.generated:
            return 1
        last = self.read(spec.name).agg(F.max(spec.key).alias("last")).first()["last"]
        return (last or 0) + 1

    def _spread(self, df: DataFrame) -> DataFrame:
        """Rows of one partition value together: rebalancing splits hot values and merges small ones."""
        return df.hint("rebalance", self.partition_facts_by) if self.partition_facts_by else df

    def _with_keys(self, df: DataFrame, spec: Table, start: int, dealt: bool) -> DataFrame:
        if spec.is_fact and not dealt:
            df = self._spread(df)  # keys come after it
        if not spec.generated or spec.key in df.columns:
            return df
        if spec.is_fact:
            return unique_row_keys(df, spec.key, start)
        return assign_keys(df, spec.key, spec.order_by, start)

    def _not_stored(self, df: DataFrame, spec: Table) -> DataFrame:
        """Rows whose business key the table does not hold; null parts compare as equal."""
        stored = self.read(spec.name).select(*[F.col(k).alias(f"_{k}") for k in spec.business_key])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in spec.business_key])
        return df.join(stored, same, "left_anti")

    def _refuse_violations(self, df: DataFrame, spec: Table) -> None:
        broken = column_rule_report(df, spec).where("violations > 0").collect()
        if broken:
            listed = "; ".join(f"{r['column_name']} {r['rule']}: {r['violations']}" for r in broken)
            raise ConstraintError(f"{spec.name}: {listed}")

    @staticmethod
    def _refuse_repeats(df: DataFrame, spec: Table) -> None:
        twice = df.groupBy(spec.key).count().where("count > 1").first()
        if twice is not None:
            raise ConstraintError(f"{spec.name}: {twice['count']} rows have {spec.key} {twice[spec.key]}")

    @staticmethod
    def _given_keys(spec: Table) -> list[list[str]]:
        """Column sets that come with the rows and must be new to the table."""
        own = [] if spec.generated else [[spec.key]]
        return own + [list(keys) for keys in spec.unique]

    def _refuse_conflicts(self, df: DataFrame, spec: Table, keys: list[str]) -> None:
        # The new rows are the build side: stored rows are filtered, not gathered.
        clash = self.read(spec.name).select(*keys).join(df.select(*keys), keys, "left_semi").first()
        if clash is not None:
            raise ConstraintError(f"{spec.name} already holds {clash.asDict()}")

    def load(self, table: str, df: DataFrame, truncate: bool = False, **options) -> int:
        """Truncate first (initial load) or only append (incremental load)."""
        if truncate:
            self.truncate(table)
        return self.append(table, df, into_empty=truncate, **options)

    # -- whole levels -----------------------------------------------------

    def load_dimensions(
        self, prepared: Mapping[str, DataFrame], truncate: bool = False, only_new: bool = False
    ) -> dict[str, int]:
        """Load all dimensions, parents first; independent ones side by side.

        ``only_new`` appends the business keys that are not stored and returns their rows.
        """
        missing = [name for name in DIMENSIONS if name not in prepared]
        if missing:
            raise ValueError(f"missing dimensions: {missing}")
        loaded = self.tables()
        # Whatever refuses its rows does so before anything is emptied or written.
        for name in [n for n in DIMENSIONS if not TABLES[n].generated]:
            ready = conform(build_dimension(name, prepared[name], loaded), TABLES[name])
            self._refuse_repeats(ready, TABLES[name])
            for keys in [] if truncate or only_new else self._given_keys(TABLES[name]):
                self._refuse_conflicts(ready, TABLES[name], keys)
        if truncate:
            self.truncate(*DIMENSIONS)

        def load_one(name: str) -> int:
            df = build_dimension(name, prepared[name], loaded)
            return self.append(name, df, into_empty=truncate, only_new=only_new)

        rows: dict[str, int] = {}
        for wave in load_order(DIMENSIONS):
            rows |= self._side_by_side(wave, load_one)
        return rows

    def load_facts(
        self,
        resolved: Mapping[str, DataFrame],
        truncate: bool = False,
        observations: Mapping[str, Observation] | None = None,
        only_new: bool = False,
        failures: dict[str, str] | None = None,
    ) -> dict[str, int]:
        """Drop rows without critical keys and load both facts; returns the rows of each.

        ``observations`` collects match counts per fact while its rows are written.
        ``only_new`` leaves out order lines that are stored.  With ``failures``, an
        error met while the rows of one fact flow is noted there and does not stop
        the other; a fact that failed has no rows.  Refused rows always raise.
        """

        def load_one(name: str) -> int:
            df, plan = resolved[name], FACT_PLANS[name]
            if truncate:
                df = self._spread(df)  # below the counts; other loads spread their staged rows
            if observations and name in observations:
                df = observe_matches(df, plan.resolved_keys, observations[name], plan.critical)
            return self.load(name, drop_incomplete(df, plan), truncate, only_new=only_new, dealt=truncate)

        def load_or_note(name: str) -> int | None:
            try:
                return load_one(name)
            except ConstraintError:
                raise
            except Exception as error:  # one fact must not stop the other
                if failures is None:
                    raise
                failures[name] = f"{type(error).__name__}: {error}"
                log.error("%s was not loaded: %s", name, failures[name])
                return None

        loaded = self._side_by_side([name for name in FACTS if name in resolved], load_or_note)
        return {name: rows for name, rows in loaded.items() if rows is not None}

    def _side_by_side(self, names: list[str], action: Callable[[str], object]) -> dict:
        """Run one action per table, several at a time."""
        with ThreadPoolExecutor(CONCURRENT_LOADS) as pool:
            return dict(zip(names, pool.map(action, names), strict=True))


class _LoadedTables(Mapping):
    """Loaded tables by name, read when asked for."""

    def __init__(self, warehouse: Warehouse):
        self._warehouse = warehouse

    def __getitem__(self, name: str) -> DataFrame:
        return self._warehouse.read(name)

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

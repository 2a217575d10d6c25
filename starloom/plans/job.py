"""A run described by a configuration file, for the command line: ``python -m starloom job.toml``.

    [source]
    kind = "parquet"              # or "catalog", "jdbc"
    root = "hdfs:///oltp"         # parquet: a folder for each table
    url = "jdbc:..."              # jdbc, with driver, user, password_variable, fetch_size and small
    [source.splits]               # jdbc: column, lower, upper, partitions of each large table
    "Sales.SalesOrderDetail" = ["SalesOrderID", 1, 100000000, 200]

    [files]
    folder = "hdfs:///files"      # the calendar and territory files, or only the latter with
    first_day = 2005-01-01        # a calendar generated between two days
    last_day = 2030-12-31

    [target]
    database = "dw"
    location = "hdfs:///dw"
    partition_facts_by = "order_date_key"
    sort_facts_by = ["customer_key"]
    log = "run_log"               # optional: a table of the database that gets the numbers of each run

    [load]
    truncate = true               # false appends
    only_new = false
    as_of = 2024-01-29            # the day departments are valid on; today if absent
    statistics = true             # analyze the loaded tables at the end

Passwords are read from the environment variable that ``password_variable`` names, never from the file.
"""

from __future__ import annotations

import datetime
import os
import tomllib
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..sources import CatalogSource, JdbcSource, ParquetSource, Source, read_flat_dimensions, read_territory_csv
from . import preflight
from .dimensions import calendar_between
from .run import RunReport, run
from .warehouse import Warehouse

# What the process returns for each outcome of a run.
EXIT_CODES = {"success": 0, "warnings": 1, "error": 2}
SECTIONS = {
    "source": {"kind", "root", "url", "driver", "user", "password_variable", "fetch_size", "small", "splits"},
    "files": {"folder", "calendar", "territory", "first_day", "last_day"},
    "target": {"database", "location", "partition_facts_by", "sort_facts_by", "log"},
    "load": {"truncate", "only_new", "as_of", "statistics"},
}
LOG_COLUMNS = "run_id string, started_at timestamp, outcome string, section string, name string, value bigint"


class ConfigError(ValueError):
    """A configuration names what is not known or lacks what is needed."""


def read_config(path: str | Path) -> dict:
    with open(path, "rb") as file:
        return checked_config(tomllib.load(file))


def checked_config(config: Mapping) -> dict:
    """The configuration with all its sections; unknown names are errors, so that a misspelt one is not ignored."""
    unknown = [s for s in config if s not in SECTIONS]
    unknown += [f"{s}.{k}" for s in SECTIONS for k in config.get(s, {}) if k not in SECTIONS[s]]
    if unknown:
        raise ConfigError(f"unknown: {', '.join(unknown)}")
    whole = {s: dict(config.get(s, {})) for s in SECTIONS}
    needed = {"parquet": ["root"], "catalog": [], "jdbc": ["url"]}
    kind = whole["source"].get("kind")
    if kind not in needed:
        raise ConfigError(f"source.kind must be one of {', '.join(needed)}, not {kind!r}")
    lacking = [f"source.{k}" for k in needed[kind] if k not in whole["source"]]
    if "folder" not in whole["files"]:
        lacking.append("files.folder")
    if ("first_day" in whole["files"]) != ("last_day" in whole["files"]):
        lacking.append("files.first_day and files.last_day, both or none")
    if lacking:
        raise ConfigError(f"missing: {', '.join(lacking)}")
    return whole


def source_of(spark: SparkSession, section: Mapping) -> Source:
    if section["kind"] == "parquet":
        return ParquetSource(spark, section["root"])
    if section["kind"] == "catalog":
        return CatalogSource(spark)
    properties = {k: section[k] for k in ("driver", "user") if k in section}
    if "password_variable" in section:
        try:
            properties["password"] = os.environ[section["password_variable"]]
        except KeyError as error:
            raise ConfigError(f"the environment has no {section['password_variable']}") from error
    splits = {table: tuple(split) for table, split in section.get("splits", {}).items()}
    options = {"fetch_size": section["fetch_size"]} if "fetch_size" in section else {}
    return JdbcSource(spark, section["url"], properties, splits, small=section.get("small", ()), **options)


def files_of(spark: SparkSession, section: Mapping) -> dict[str, DataFrame]:
    names = {k: section[k] for k in ("calendar", "territory") if k in section}
    if "first_day" not in section:
        return read_flat_dimensions(spark, section["folder"], **names)
    territory = names.get("territory", "DimSalesTerritory.csv")
    return {
        "dim_date": calendar_between(spark, section["first_day"], section["last_day"]),
        "dim_sales_territory": read_territory_csv(spark, f"{section['folder']}/{territory}"),
    }


def warehouse_of(spark: SparkSession, section: Mapping) -> Warehouse:
    return Warehouse(
        spark,
        section.get("database", "dw"),
        section.get("location"),
        section.get("partition_facts_by"),
        section.get("sort_facts_by", ()),
    )


@dataclass
class JobResult:
    run_id: str
    started_at: datetime.datetime
    seconds: float
    source_rows: dict[str, int]
    target: preflight.TargetState
    report: RunReport | None  # None where only the preflight was asked for

    @property
    def exit_code(self) -> int:
        return EXIT_CODES[self.report.outcome] if self.report else 0


def run_job(spark: SparkSession, config: Mapping, check_only: bool = False) -> JobResult:
    """Preflight, then the run that the configuration describes.

    A source table that is unreachable or lacks a column raises before anything is created or emptied.
    """
    config = checked_config(config)
    started = datetime.datetime.now(datetime.UTC)
    source, warehouse = source_of(spark, config["source"]), warehouse_of(spark, config["target"])
    files = files_of(spark, config["files"])
    seconds, (source_rows, target) = preflight.timed(lambda: preflight.check(source, warehouse))
    result = JobResult(uuid.uuid4().hex, started, seconds, source_rows, target, None)
    if check_only:
        return result
    load = config["load"]
    took, result.report = preflight.timed(
        lambda: run(
            warehouse,
            source,
            files,
            truncate=load.get("truncate", False),
            as_of=load.get("as_of"),
            only_new=load.get("only_new", False),
            statistics=load.get("statistics", False),
        )
    )
    result.seconds += took
    if "log" in config["target"]:
        log_run(warehouse, result, config["target"]["log"])
    return result


def numbers(result: JobResult) -> list[tuple[str, str, int]]:
    """The numbers of a run as (section, name, value), a few hundred rows."""
    report = result.report
    parts = {
        "source rows": result.source_rows,
        "extracted": report.extracted,
        "loaded": {**report.dimension_rows, **report.summary["fact_stats"]},
        "dropped": report.dropped,
        "orphans": report.orphans,
        "violations": report.violations,
        "duplicate keys": report.duplicate_keys,
        **{f"found in {table}": counts for table, counts in report.matches.items()},
        **{f"lost in {column}": counts for column, counts in report.lost_values.items()},
        "run": {"seconds": round(result.seconds), "failures": len(report.failures)},
    }
    return [(section, name, int(value)) for section, counts in parts.items() for name, value in counts.items()]


def log_run(warehouse: Warehouse, result: JobResult, table: str) -> None:
    """Append the numbers of a run to a table of the warehouse."""
    rows = [(result.run_id, result.started_at, result.report.outcome, *line) for line in numbers(result)]
    log = warehouse.spark.createDataFrame(rows, LOG_COLUMNS).coalesce(1)
    log.write.mode("append").saveAsTable(warehouse.name(table))


def text(result: JobResult) -> str:
    """The result as lines to read."""
    target = result.target
    lines = [
        f"source: {len(result.source_rows)} tables, {sum(result.source_rows.values()):,} rows",
        f"target: {target.catalog}.{target.database} as {target.user}, Spark {target.version}, "
        + (f"{len(target.found)} tables found" if target.is_present else "to be created"),
    ]
    if result.report:
        report = result.report
        lines.append(f"extracted: {report.total_extracted:,} rows")
        for name, rows in {**report.dimension_rows, **report.summary["fact_stats"]}.items():
            status = report.failures.get(name, report.table_status.get(name, ""))
            lines.append(f"  {name}: {rows:,} rows loaded, {report.dropped.get(name, 0):,} dropped, {status}")
        lost = sum(report.orphans.values())
        lines.append(f"keys: {lost:,} orphans, {sum(report.violations.values()):,} violations of {len(report.violations)} rules")
        ok = sum("OK" in s for s in report.table_status.values())
        lines.append(f"tables with rows: {ok} of {len(report.table_status)}")
        lines.append(f"outcome: {report.outcome} after {result.seconds:.0f} s")
    return "\n".join(lines)


def main(arguments: Sequence[str]) -> int:
    """``job.toml [--check]``: prints the result and returns 0 for success, 1 for warnings and 2 for an error."""
    check_only = "--check" in arguments
    paths = [a for a in arguments if not a.startswith("--")]
    if len(paths) != 1 or any(a.startswith("--") and a != "--check" for a in arguments):
        print("usage: python -m starloom job.toml [--check]")
        return EXIT_CODES["error"]
    try:
        config = read_config(paths[0])
        spark = SparkSession.builder.appName("starloom").getOrCreate()
        result = run_job(spark, config, check_only)
    except (ConfigError, preflight.PreflightError, OSError, ValueError) as error:
        print(f"{type(error).__name__}: {error}")
        return EXIT_CODES["error"]
    print(text(result))
    return result.exit_code

"""Post-load reports and the outcome of a run."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import FOREIGN_KEYS, TABLES
from ..functions.keys import normalize_key
from ..operators.dedupe import duplicate_summary
from ..operators.integrity import column_rules, foreign_key_report, primary_key_report, unique_report
from ..operators.lookup import with_match_marker
from .dimensions import UNKNOWN_PLACE
from .facts import FACT_PLANS


def table_report(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """``table_name, is_present, row_count, status`` for every target table.

    A table given as ``None``, or not at all, is reported as missing.
    """
    rows = []
    for name in TABLES:
        df = tables.get(name)
        if df is None:
            counted = spark.range(1).select(F.lit(False).alias("is_present"), F.lit(0).cast("bigint").alias("row_count"))
        else:
            counted = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(True).alias("is_present"), "row_count")
        rows.append(counted.select(F.lit(name).alias("table_name"), "is_present", "row_count"))
    status = F.when(~F.col("is_present"), "missing").when(F.col("row_count") > 0, "OK").otherwise("empty")
    return reduce(DataFrame.unionByName, rows).withColumn("status", status)


def status_count(report: DataFrame, word: str = "OK") -> DataFrame:
    """How many tables have a status that contains ``word``, of how many."""
    return report.agg(
        F.count_if(F.col("status").contains(word)).alias("matching"), F.count(F.lit(1)).alias("total")
    )


def place_matches(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of the place lookups that found a member: ``table_name, total_rows, matched``.

    Geography counts places with a known territory, without the unknown member;
    customers and resellers count rows that did not fall back to it.
    """
    geography = tables["dim_geography"]
    is_unknown = (F.col("postal_code") == UNKNOWN_PLACE["postal_code"]) & (
        F.col("country_region_code") == UNKNOWN_PLACE["country_region_code"]
    )
    unknown = geography.where(is_unknown)
    marked = {
        "dim_geography": with_match_marker(
            geography.where(~is_unknown), tables["dim_sales_territory"], "sales_territory_key", "_hit"
        ),
        "dim_customer": with_match_marker(tables["dim_customer"], unknown, "geography_key", "_miss"),
        "dim_reseller": with_match_marker(tables["dim_reseller"], unknown, "geography_key", "_miss"),
    }
    counts = [
        df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col("_hit") if "_hit" in df.columns else ~F.col("_miss")).alias("matched"),
        ).select(F.lit(name).alias("table_name"), "total_rows", "matched")
        for name, df in marked.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def decisive_orphans(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orphans of the six relationships that decide the outcome."""
    return foreign_key_report(tables, [fk for fk in FOREIGN_KEYS if fk.decides])


def constraint_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, rule, violations`` of all primary keys, unique columns, not-null and length rules."""
    keys = primary_key_report(tables).unionByName(unique_report(tables))
    rules = column_rules(tables).select("table_name", F.concat_ws(" ", "column_name", "rule").alias("rule"), "violations")
    unique = F.concat(F.lit("unique "), "key").alias("rule")
    return keys.select("table_name", unique, (F.col("surplus_rows") + F.col("null_rows")).alias("violations")).unionByName(rules)


def duplicate_lookup_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Alternate keys that stand for several rows, for each lookup of the facts.

    ``table_name, alternate_key, duplicated_keys, rows_sharing_a_key, surplus_rows``.  A lookup takes the
    lowest key of such rows.  Null keys are never looked up and do not count.
    """
    looked_up = dict.fromkeys((name, alternate) for plan in FACT_PLANS.values() for name, alternate, _ in plan.lookups)
    reports = []
    for name, alternate in looked_up:
        keys = tables[name].select(alternate)
        if name == "dim_product":
            keys = normalize_key(keys, alternate)
        summary = duplicate_summary(keys.where(F.col(alternate).isNotNull()), [alternate])
        reports.append(summary.select(F.lit(name).alias("table_name"), F.lit(alternate).alias("alternate_key"), "*"))
    return reduce(DataFrame.unionByName, reports)


def run_outcome(fact_rows: int, keys_intact: bool, tables_ok: int, tables_total: int, violations: int = 0) -> str:
    """``success``, ``warnings`` (facts exist but a check failed) or ``error`` (no facts)."""
    if fact_rows <= 0:
        return "error"
    return "success" if keys_intact and tables_ok == tables_total and violations == 0 else "warnings"


def run_summary(dimension_rows: Mapping[str, int], fact_rows: Mapping[str, int]) -> dict:
    return {
        "dimensions_loaded": len(dimension_rows),
        "facts_loaded": len(fact_rows),
        "total_fact_records": sum(fact_rows.values()),
        "fact_stats": dict(fact_rows),
    }


def outcome_frame(report: DataFrame, orphans: DataFrame, constraints: DataFrame) -> DataFrame:
    """The outcome as one row, from a table report, the decisive orphan checks and the constraint report."""
    facts = F.when(F.col("table_name").startswith("fact_"), F.col("row_count")).otherwise(0)
    tables = report.select(
        F.col("status").contains("OK").cast("int").alias("ok"),
        F.lit(1).alias("listed"),
        facts.alias("fact_rows"),
        F.lit(0).cast("bigint").alias("lost"),
        F.lit(0).cast("bigint").alias("bad"),
    )
    broken = orphans.where("decides").select(
        F.lit(0).alias("ok"), F.lit(0).alias("listed"), F.lit(0).cast("bigint").alias("fact_rows"), F.col("orphans").alias("lost"), F.lit(0).cast("bigint").alias("bad")
    )
    violated = constraints.select(
        F.lit(0).alias("ok"), F.lit(0).alias("listed"), F.lit(0).cast("bigint").alias("fact_rows"), F.lit(0).cast("bigint").alias("lost"), F.col("violations").alias("bad")
    )
    totals = tables.unionByName(broken).unionByName(violated).agg(
        F.sum("ok").alias("tables_ok"),
        F.sum("listed").alias("tables_total"),
        F.sum("fact_rows").alias("fact_rows"),
        F.sum("lost").alias("orphans"),
        F.sum("bad").alias("violations"),
    )
    whole = (F.col("orphans") == 0) & (F.col("violations") == 0) & (F.col("tables_ok") == F.col("tables_total"))
    return totals.withColumn(
        "outcome", F.when(F.col("fact_rows") <= 0, "error").when(whole, "success").otherwise("warnings")
    )


def named_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several frames as the columns of one row."""
    rows = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in frames.items()]
    counted = reduce(DataFrame.unionByName, rows)
    return counted.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in frames])


def total_rows(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of all frames together."""
    rows = [df.agg(F.count(F.lit(1)).alias("n")) for df in frames.values()]
    return reduce(DataFrame.unionByName, rows).agg(F.sum("n").alias("total_rows"))

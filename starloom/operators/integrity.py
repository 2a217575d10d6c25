"""Constraint checks, each one pass over a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import FOREIGN_KEYS, TABLES, ForeignKey, Table


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def foreign_key_report(
    tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey] = FOREIGN_KEYS
) -> DataFrame:
    """Orphan rows per foreign key: ``constraint, child, parent, orphans``.

    Each child table is read once.  Its key columns are turned into
    ``(constraint, value)`` and counted before any shuffle, so a hot key costs
    one row per task, and only distinct values meet the parents' keys.  Nothing
    is broadcast by hint: parents may be as large as they like.
    """
    children = []
    for child in dict.fromkeys(fk.child for fk in keys):
        own = [fk for fk in keys if fk.child == child]
        pairs = ", ".join(f"'{fk.name}', cast({fk.column} as bigint)" for fk in own)
        children.append(
            tables[child]
            .select(F.expr(f"stack({len(own)}, {pairs}) as (constraint_name, value)"))
            .where(F.col("value").isNotNull())
            .groupBy("constraint_name", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
    parents = []
    for parent in dict.fromkeys(fk.parent for fk in keys):
        names = [fk.name for fk in keys if fk.parent == parent]
        key = F.col(TABLES[parent].key).cast("bigint").alias("value")
        parents.append(tables[parent].select(F.explode(F.lit(names)).alias("constraint_name"), key))
    lost = (
        _union(children)
        .join(_union(parents), ["constraint_name", "value"], "left_anti")
        .groupBy("constraint_name")
        .agg(F.sum("n").alias("orphans"))
    )
    listed = lost.sparkSession.createDataFrame(
        [(fk.name, fk.child, fk.parent, fk.decides) for fk in keys],
        "constraint_name string, child string, parent string, decides boolean",
    )
    return listed.join(lost, "constraint_name", "left").select(
        "constraint_name", "child", "parent", "decides", F.coalesce("orphans", F.lit(0)).alias("orphans")
    )


def uniqueness_report(df: DataFrame, table: str, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """Rows beyond the first of each key, and rows with a null key part."""
    reports = []
    for keys in key_sets:
        incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        reports.append(
            df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_rows"))
            .agg(
                F.coalesce(F.sum(F.when(~incomplete, F.col("_rows") - 1)), F.lit(0)).alias("surplus_rows"),
                F.coalesce(F.sum(F.when(incomplete, F.col("_rows"))), F.lit(0)).alias("null_rows"),
            )
            .select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key"), "surplus_rows", "null_rows")
        )
    return _union(reports)


def primary_key_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([uniqueness_report(df, name, [[TABLES[name].key]]) for name, df in tables.items()])


def unique_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [uniqueness_report(df, name, TABLES[name].unique) for name, df in tables.items() if TABLES[name].unique]
    )


def column_rule_report(df: DataFrame, table: Table) -> DataFrame:
    """Violations of every not-null and length rule of a table, in one aggregate."""
    present = set(df.columns)
    rules = [(c, "not null", f"{c} is null") for c in table.required if c in present]
    rules += [(c, f"length <= {n}", f"length({c}) > {n}") for c, n in table.length_limits.items() if c in present]
    counted = df.selectExpr(*[f"count_if({broken}) as r{i}" for i, (_, _, broken) in enumerate(rules)])
    rows = ", ".join(
        f"struct('{c}' as column_name, '{rule}' as rule, r{i} as violations)" for i, (c, rule, _) in enumerate(rules)
    )
    return counted.selectExpr(f"'{table.name}' as table_name", f"inline(array({rows}))")


def column_rules(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([column_rule_report(df, TABLES[name]) for name, df in tables.items()])

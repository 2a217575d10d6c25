"""What a run needs, looked at before it starts: source tables, their columns and rows, and the target."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import TABLES
from ..sources.tables import Source
from .extracts import (
    ADDRESS,
    CURRENCY,
    EMPLOYEE,
    ORDER_DETAIL,
    ORDER_HEADER,
    ORDER_HEADER_KEPT,
    PERSON_NAME,
    PRODUCT,
    PRODUCT_CATEGORY,
    PRODUCT_SUBCATEGORY,
    PROMOTION,
    SALES_REASON,
    order_line_count,
)
from .warehouse import Warehouse

# Source table -> the columns that the extracts read.
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "HumanResources.Department": ("DepartmentID", "Name"),
    "HumanResources.Employee": tuple(EMPLOYEE),
    "HumanResources.EmployeeDepartmentHistory": ("BusinessEntityID", "DepartmentID", "StartDate", "EndDate"),
    "HumanResources.EmployeePayHistory": ("BusinessEntityID", "RateChangeDate", "Rate", "PayFrequency"),
    "Person.Address": ("AddressID", "StateProvinceID", *(c for c in ADDRESS if c != "StateProvinceCode")),
    "Person.BusinessEntityAddress": ("BusinessEntityID", "AddressID"),
    "Person.CountryRegion": ("CountryRegionCode", "Name"),
    "Person.EmailAddress": ("BusinessEntityID", "EmailAddress"),
    "Person.Person": ("BusinessEntityID", *PERSON_NAME, "Demographics"),
    "Person.PersonPhone": ("BusinessEntityID", "PhoneNumber"),
    "Person.StateProvince": ("StateProvinceID", "StateProvinceCode", "Name", "CountryRegionCode"),
    "Production.Product": (*PRODUCT, "ProductModelID"),
    "Production.ProductCategory": tuple(PRODUCT_CATEGORY),
    "Production.ProductDescription": ("ProductDescriptionID", "Description"),
    "Production.ProductModel": ("ProductModelID", "Name"),
    "Production.ProductModelProductDescriptionCulture": ("ProductModelID", "ProductDescriptionID", "CultureID"),
    "Production.ProductSubcategory": tuple(PRODUCT_SUBCATEGORY),
    "Sales.Currency": tuple(CURRENCY),
    "Sales.CurrencyRate": ("CurrencyRateID", "ToCurrencyCode"),
    "Sales.Customer": ("CustomerID", "PersonID", "StoreID"),
    "Sales.SalesOrderDetail": ("SalesOrderID", *ORDER_DETAIL),
    "Sales.SalesOrderHeader": (*ORDER_HEADER_KEPT, *ORDER_HEADER, "CurrencyRateID", "OnlineOrderFlag", "SalesPersonID"),
    "Sales.SalesReason": tuple(SALES_REASON),
    "Sales.SalesTerritory": ("TerritoryID", "CountryRegionCode"),
    "Sales.SpecialOffer": tuple(PROMOTION),
    "Sales.Store": ("BusinessEntityID", "Name", "Demographics"),
    "Sales.vStoreWithContacts": ("BusinessEntityID", "PhoneNumber"),
}


class PreflightError(RuntimeError):
    """The source or the target is not what a run needs."""


def source_report(source: Source, wanted: Mapping[str, tuple[str, ...]] = SOURCE_COLUMNS) -> DataFrame:
    """``table_name, status, row_count`` of the source tables that the extracts read.

    Status is ``ok``, ``lacks`` with the columns that are not there, or ``unreachable`` with the cause.  Names of
    columns are compared as Spark resolves them.  Rows of all reachable tables are counted in one job; an
    unreachable table has null.
    """
    spark = source.spark
    exact = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    rows = []
    for name, columns in wanted.items():
        try:
            df = source.table(name)
            held = set(df.columns) if exact else {c.lower() for c in df.columns}
        except Exception as error:  # one table must not hide the others
            cause = str(error).strip().split("\n")[0]
            rows.append(_line(spark.range(1), name, f"unreachable: {type(error).__name__}: {cause}", F.lit(None).cast("bigint")))
            continue
        lacking = [c for c in columns if (c if exact else c.lower()) not in held]
        counted = df.agg(F.count(F.lit(1)).alias("n"))
        rows.append(_line(counted, name, f"lacks: {', '.join(lacking)}" if lacking else "ok", F.col("n")))
    return reduce(DataFrame.unionByName, rows)


def _line(df: DataFrame, name: str, status: str, count: Column) -> DataFrame:
    return df.select(F.lit(name).alias("table_name"), F.lit(status).alias("status"), count.alias("row_count"))


@dataclass(frozen=True)
class TargetState:
    database: str
    is_present: bool
    found: tuple[str, ...]
    missing: tuple[str, ...]
    catalog: str
    user: str
    version: str


def target_state(warehouse: Warehouse) -> TargetState:
    """Whether the database is there, which of its tables are, and where and as whom this session works."""
    spark: SparkSession = warehouse.spark
    is_present = spark.catalog.databaseExists(warehouse.database)
    found = tuple(t for t in TABLES if is_present and warehouse.exists(t))
    place = spark.sql("select current_catalog() as catalog, current_user() as user, version() as version").first()
    return TargetState(
        database=warehouse.database,
        is_present=is_present,
        found=found,
        missing=tuple(t for t in TABLES if t not in found),
        catalog=place["catalog"],
        user=place["user"],
        version=place["version"].split(" ")[0],
    )


def timed(action: Callable[[], object]) -> tuple[float, object]:
    started = time.perf_counter()
    result = action()
    return time.perf_counter() - started, result


def probe_times(source: Source, warehouse: Warehouse, since: str = "2012-01-01") -> dict[str, tuple[float, int]]:
    """Seconds and result of two probes: the lines of orders since a date, and the tables of the target."""

    def lines() -> int:
        return order_line_count(source, since).first()["line_count"]

    def tables() -> int:
        return len(target_state(warehouse).found)

    return {"source lines": timed(lines), "target tables": timed(tables)}


def check(source: Source, warehouse: Warehouse) -> tuple[dict[str, int], TargetState]:
    """Rows of each source table and the state of the target; raises where a table is unreachable or lacks a column."""
    report = source_report(source).collect()  # a row for each source table
    wrong = [f"{r['table_name']} {r['status']}" for r in report if r["status"] != "ok"]
    if wrong:
        raise PreflightError("; ".join(wrong))
    return {r["table_name"]: r["row_count"] for r in report}, target_state(warehouse)

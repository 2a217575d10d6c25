"""Order lines to fact rows with surrogate keys and measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import (
    add_date_keys,
    coerce_whole_numbers,
    fill_missing,
    normalize_key,
    trimmed_text,
)
from ..functions.measures import derived_measures
from ..operators.lookup import lookup_date, resolve
from ..session import write_through
from ..sources.tables import Source
from .extracts import DEFAULT_CURRENCY, channel_headers, order_headers, order_lines, store_customers

# Order date column -> date key column.
DATE_KEYS = {"OrderDate": "order_date_key", "DueDate": "due_date_key", "ShipDate": "ship_date_key"}

Lookup = tuple[str, str, str]  # dimension, alternate key, surrogate key

_CUSTOMER: Lookup = ("dim_customer", "customer_alternate_key", "customer_key")
_RESELLER: Lookup = ("dim_reseller", "reseller_alternate_key", "reseller_key")
_EMPLOYEE: Lookup = ("dim_employee", "employee_alternate_key", "employee_key")
_CURRENCY: Lookup = ("dim_currency", "currency_alternate_key", "currency_key")
_TERRITORY: Lookup = ("dim_sales_territory", "sales_territory_alternate_key", "sales_territory_key")
_PRODUCT: Lookup = ("dim_product", "product_alternate_key", "product_key")
_PROMOTION: Lookup = ("dim_promotion", "promotion_alternate_key", "promotion_key")


@dataclass(frozen=True)
class FactPlan:
    """What a fact looks up on the order, what on the line, and what it must find."""

    table: str
    online: bool
    order_lookups: Sequence[Lookup]
    line_lookups: Sequence[Lookup]
    critical: Sequence[str]

    @property
    def lookups(self) -> list[Lookup]:
        return [*self.order_lookups, *self.line_lookups]

    @property
    def resolved_keys(self) -> list[str]:
        return [key for _, _, key in self.lookups] + list(DATE_KEYS.values())


INTERNET_SALES = FactPlan(
    "fact_internet_sales",
    online=True,
    order_lookups=[_CUSTOMER, _CURRENCY, _TERRITORY],
    line_lookups=[_PRODUCT, _PROMOTION],
    critical=["product_key", "customer_key", "order_date_key"],
)
RESELLER_SALES = FactPlan(
    "fact_reseller_sales",
    online=False,
    order_lookups=[_RESELLER, _EMPLOYEE, _TERRITORY, _CURRENCY],
    line_lookups=[_PRODUCT, _PROMOTION],
    critical=["product_key", "reseller_key", "employee_key", "order_date_key"],
)
FACT_PLANS = {p.table: p for p in (INTERNET_SALES, RESELLER_SALES)}


def _order_part(df: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup]) -> DataFrame:
    df = fill_missing(df, ["currency_alternate_key"], DEFAULT_CURRENCY)
    df = resolve(add_date_keys(df, DATE_KEYS), dims, lookups)
    for key in DATE_KEYS.values():
        if key in df.columns:
            df = lookup_date(df, dims["dim_date"], key)
    return df.drop(*DATE_KEYS)


def _line_part(df: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup]) -> DataFrame:
    return resolve(normalize_key(df, "product_alternate_key"), dims, lookups)


def _needed_dims(dims: Mapping[str, DataFrame], plan: FactPlan) -> dict[str, DataFrame]:
    """The dimensions a fact looks up, product codes without surrounding blanks."""
    needed = {name: dims[name].select(alternate, key) for name, alternate, key in plan.lookups}
    needed["dim_product"] = normalize_key(needed["dim_product"], "product_alternate_key")
    needed["dim_date"] = dims["dim_date"]
    return needed


def _finish(df: DataFrame, plan: FactPlan) -> DataFrame:
    if "SalesOrderNumber" not in df.columns:
        raise ValueError(f"{plan.table} needs the column SalesOrderNumber")
    df = df.withColumnRenamed("SalesOrderNumber", "sales_order_number")
    if plan.online:
        df = coerce_whole_numbers(df, plan.resolved_keys)
    return derived_measures(df)


def resolve_fact(lines: DataFrame, dims: Mapping[str, DataFrame], plan: FactPlan) -> DataFrame:
    """Every key and measure of extracted order lines; unresolved keys are null."""
    dims = _needed_dims(dims, plan)
    return _finish(_line_part(_order_part(lines, dims, plan.order_lookups), dims, plan.line_lookups), plan)


def _orders_with_keys(source: Source, dims: Mapping[str, DataFrame], plan: FactPlan) -> DataFrame:
    """Orders with their keys; store and reseller key reach an order in one join, by its customer."""
    if plan.online:
        return _order_part(order_headers(source, online=True), dims, plan.order_lookups)
    customers = resolve(store_customers(source), dims, [_RESELLER])
    orders = channel_headers(source, online=False).join(customers, "CustomerID").drop("CustomerID")
    return _order_part(orders, dims, [lookup for lookup in plan.order_lookups if lookup != _RESELLER])


def _with_products(
    lines: DataFrame, source: Source, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup]
) -> DataFrame:
    """Lines with cost and keys; cost and product key arrive in one join."""
    products = source.table("Production.Product").select(
        F.col("ProductID").alias("product_id"), F.col("StandardCost").alias("product_standard_cost")
    )
    keyed = resolve(
        products.withColumn("product_alternate_key", trimmed_text("product_id")),
        dims,
        [lookup for lookup in lookups if lookup == _PRODUCT],
    )
    found = lines.withColumnRenamed("product_alternate_key", "product_id").join(keyed, "product_id").drop("product_id")
    return resolve(found, dims, [lookup for lookup in lookups if lookup != _PRODUCT])


def resolve_fact_from_source(source: Source, dims: Mapping[str, DataFrame], plan: FactPlan) -> DataFrame:
    """The same rows as :func:`resolve_fact`, with lookups before the fan-out.

    Customer, reseller, employee, currency, territory and dates belong to the
    order, so they are resolved once per order instead of once per line.  Lines
    move at most twice: to meet their order, and, those of the fact's channel
    alone, to meet their product.
    """
    dims = _needed_dims(dims, plan)
    orders = _orders_with_keys(source, dims, plan)
    lines = orders.join(order_lines(source), "SalesOrderID").drop("SalesOrderID")
    return _finish(_with_products(lines, source, dims, plan.line_lookups), plan)


def resolve_facts_from_source(
    source: Source, dims: Mapping[str, DataFrame], plans: Sequence[FactPlan]
) -> dict[str, DataFrame]:
    """The rows of :func:`resolve_fact_from_source` for facts that look up the same on the line.

    Lines are read and moved for all facts together: to their product while they
    are narrow, then to the orders of every channel.  What they found is written
    once, lines of an order side by side, and each fact reads its own from there.
    """
    if len({tuple(plan.line_lookups) for plan in plans}) != 1:
        raise ValueError("facts that are resolved together need the same line lookups")
    needed = {plan.table: _needed_dims(dims, plan) for plan in plans}
    orders = [
        _orders_with_keys(source, needed[plan.table], plan).withColumn("_fact", F.lit(plan.table)) for plan in plans
    ]
    columns = {table: [c for c in df.columns if c not in ("SalesOrderID", "_fact")] for table, df in zip(needed, orders)}
    lines = _with_products(order_lines(source), source, needed[plans[0].table], plans[0].line_lookups)
    on_line = [c for c in lines.columns if c != "SalesOrderID"]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), orders)
    staged = write_through(together.join(lines, "SalesOrderID").drop("SalesOrderID"), "fact-lines", compression="zstd")
    return {
        plan.table: _finish(staged.where(F.col("_fact") == plan.table).select(*columns[plan.table], *on_line), plan)
        for plan in plans
    }


def drop_incomplete(df: DataFrame, plan: FactPlan) -> DataFrame:
    """Only rows whose critical keys were all found."""
    return df.dropna(subset=list(plan.critical))


def incomplete_rows(df: DataFrame, plan: FactPlan) -> DataFrame:
    """How many rows lack each critical key, and how many are dropped."""
    complete = F.lit(True)
    for key in plan.critical:
        complete = complete & F.col(key).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~complete).alias("dropped_rows"),
        *[F.count_if(F.col(k).isNull()).alias(f"missing_{k}") for k in plan.critical],
    )


def fact_internet_sales(lines: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return drop_incomplete(resolve_fact(lines, dims, INTERNET_SALES), INTERNET_SALES)


def fact_reseller_sales(lines: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return drop_incomplete(resolve_fact(lines, dims, RESELLER_SALES), RESELLER_SALES)


def build_fact(source: Source, dims: Mapping[str, DataFrame], plan: FactPlan) -> DataFrame:
    """A fact straight from the source tables."""
    return drop_incomplete(resolve_fact_from_source(source, dims, plan), plan)

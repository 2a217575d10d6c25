"""The target star schema: tables, column rules and foreign keys."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False
    max_length: int | None = None
    default: object = None


@dataclass(frozen=True)
class Table:
    """One target table.

    ``key`` is the primary key.  When ``generated`` is true the key is assigned
    on load, in the order of ``order_by``.
    """

    name: str
    key: str
    columns: tuple[Column, ...]
    generated: bool = True
    order_by: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()

    @property
    def is_fact(self) -> bool:
        return self.name.startswith("fact_")

    @property
    def business_key(self) -> tuple[str, ...]:
        """What tells a row from the others in its source; a place has nothing but all its columns."""
        if self.unique:
            return self.unique[0]
        if not self.generated:
            return (self.key,)
        return tuple(c.name for c in self.columns if c.name.endswith("_alternate_key")) or self.order_by

    @property
    def column_types(self) -> dict[str, str]:
        key = {self.key: "bigint"} if self.generated else {}
        return key | {c.name: c.type for c in self.columns}

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in self.column_types.items()))

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def length_limits(self) -> dict[str, int]:
        return {c.name: c.max_length for c in self.columns if c.max_length}


@dataclass(frozen=True)
class ForeignKey:
    """``child.column`` must hold a key of ``parent``.

    ``decides`` marks the six relationships that decide the outcome of a run.
    """

    name: str
    child: str
    column: str
    parent: str
    decides: bool = field(default=False)

    @property
    def parent_key(self) -> str:
        return TABLES[self.parent].key


def text(name: str, limit: int | None = None, required: bool = False) -> Column:
    return Column(name, "string", required, limit)


def small(name: str, required: bool = False) -> Column:
    return Column(name, "smallint", required)


def integer(name: str, required: bool = False) -> Column:
    return Column(name, "int", required)


def long(name: str, required: bool = False) -> Column:
    return Column(name, "bigint", required)


def money(name: str, required: bool = False) -> Column:
    return Column(name, "decimal(19,4)", required)


def real(name: str, required: bool = False, default: float | None = None) -> Column:
    return Column(name, "double", required, default=default)


def day(name: str, required: bool = False) -> Column:
    return Column(name, "date", required)


def moment(name: str, required: bool = False) -> Column:
    return Column(name, "timestamp_ntz", required)


def flag(name: str, required: bool = False, default: bool | None = None) -> Column:
    return Column(name, "boolean", required, default=default)


# The column names, types, limits and defaults of the target schema.

DIM_DATE = Table(
    "dim_date",
    "date_key",
    (
        integer("date_key", True),
        day("full_date_alternate_key", True),
        small("day_number_of_week", True),
        text("day_name_of_week", 10, True),
        small("day_number_of_month", True),
        small("day_number_of_year", True),
        small("week_number_of_year", True),
        text("month_name", 10, True),
        small("month_number_of_year", True),
        small("calendar_quarter", True),
        small("calendar_year", True),
        small("calendar_semester", True),
        small("fiscal_quarter", True),
        small("fiscal_year", True),
        small("fiscal_semester", True),
    ),
    generated=False,
)

DIM_CURRENCY = Table(
    "dim_currency",
    "currency_key",
    (text("currency_alternate_key", 3, True), text("currency_name", 50, True)),
    order_by=("currency_alternate_key", "currency_name"),
)

DIM_SALES_TERRITORY = Table(
    "dim_sales_territory",
    "sales_territory_key",
    (
        integer("sales_territory_key", True),
        integer("sales_territory_alternate_key"),
        text("sales_territory_region", 50, True),
        text("sales_territory_country", 50, True),
        text("sales_territory_group", 50),
    ),
    generated=False,
)

DIM_GEOGRAPHY = Table(
    "dim_geography",
    "geography_key",
    (
        text("city", 30),
        text("state_province_code", 3),
        text("state_province_name", 50),
        text("country_region_code", 3),
        text("country_region_name", 50),
        text("postal_code", 15),
        integer("sales_territory_key"),
    ),
    order_by=(
        "country_region_code",
        "state_province_code",
        "city",
        "postal_code",
        "sales_territory_key",
        "state_province_name",
        "country_region_name",
    ),
)

DIM_CUSTOMER = Table(
    "dim_customer",
    "customer_key",
    (
        text("customer_alternate_key", 15, True),
        long("geography_key", True),
        text("title", 8),
        text("first_name", 50),
        text("middle_name", 50),
        text("last_name", 50),
        flag("name_style", default=False),
        day("birth_date"),
        text("marital_status", 1),
        text("suffix", 10),
        text("gender", 1),
        text("email_address", 50),
        text("yearly_income", 25),
        small("total_children"),
        small("number_children_at_home"),
        text("education", 40),
        text("house_owner_flag", 1),
        small("number_cars_owned"),
        text("address_line1", 120),
        text("address_line2", 120),
        text("phone", 20),
        day("date_first_purchase"),
        text("commute_distance", 15),
    ),
    order_by=("customer_alternate_key",),
)

DIM_PRODUCT_CATEGORY = Table(
    "dim_product_category",
    "product_category_key",
    (integer("product_category_alternate_key"), text("product_category_name", 50, True)),
    order_by=("product_category_alternate_key", "product_category_name"),
)

DIM_PRODUCT_SUBCATEGORY = Table(
    "dim_product_subcategory",
    "product_subcategory_key",
    (
        integer("product_subcategory_alternate_key"),
        text("product_subcategory_name", 50, True),
        long("product_category_key"),
    ),
    order_by=("product_subcategory_alternate_key", "product_subcategory_name"),
)

DIM_PRODUCT = Table(
    "dim_product",
    "product_key",
    (
        text("product_alternate_key", 25),
        long("product_subcategory_key"),
        text("weight_unit_measure_code", 3),
        text("size_unit_measure_code", 3),
        text("product_name", 50, True),
        money("standard_cost"),
        flag("finished_goods_flag", True, default=False),
        text("color", 15),
        small("safety_stock_level"),
        small("reorder_point"),
        money("list_price"),
        text("size", 50),
        real("weight"),
        integer("days_to_manufacture"),
        text("product_line", 2),
        text("class", 2),
        text("style", 2),
        text("model_name", 50),
        text("description"),
        moment("sell_start_date"),
        moment("sell_end_date"),
    ),
    order_by=("product_alternate_key",),
)

DIM_PROMOTION = Table(
    "dim_promotion",
    "promotion_key",
    (
        integer("promotion_alternate_key"),
        text("promotion_name", 255),
        real("discount_pct"),
        text("promotion_type", 50),
        text("promotion_category", 50),
        moment("start_date", True),
        moment("end_date"),
        integer("min_qty"),
        integer("max_qty"),
    ),
    order_by=("promotion_alternate_key", "promotion_name"),
)

DIM_SALES_REASON = Table(
    "dim_sales_reason",
    "sales_reason_key",
    (
        integer("sales_reason_alternate_key", True),
        text("sales_reason_name", 50, True),
        text("sales_reason_reason_type", 50, True),
    ),
    order_by=("sales_reason_alternate_key", "sales_reason_name", "sales_reason_reason_type"),
)

DIM_RESELLER = Table(
    "dim_reseller",
    "reseller_key",
    (
        long("geography_key", True),
        text("reseller_alternate_key", 15),
        text("phone", 25),
        text("business_type", 20, True),
        text("reseller_name", 50, True),
        integer("number_employees"),
        text("address_line1", 60),
        text("address_line2", 60),
        money("annual_sales"),
        text("bank_name", 50),
        money("annual_revenue"),
        integer("year_opened"),
    ),
    order_by=("reseller_alternate_key", "geography_key"),
)

DIM_EMPLOYEE = Table(
    "dim_employee",
    "employee_key",
    (
        integer("employee_alternate_key"),
        text("first_name", 50, True),
        text("last_name", 50, True),
        text("middle_name", 50),
        flag("name_style", True, default=False),
        text("title", 50),
        day("hire_date"),
        day("birth_date"),
        text("login_id", 500),
        text("email_address", 50),
        text("phone", 25),
        text("marital_status", 1),
        flag("salaried_flag"),
        text("gender", 1),
        small("pay_frequency"),
        money("base_rate"),
        small("vacation_hours"),
        small("sick_leave_hours"),
        flag("current_flag", True, default=True),
        text("department_name", 50),
        day("start_date"),
        day("end_date"),
    ),
    order_by=(
        "employee_alternate_key",
        "department_name",
        "start_date",
        "end_date",
        "base_rate",
        "pay_frequency",
        "email_address",
        "phone",
    ),
)

_SALE_MEASURES = (
    text("sales_order_number", 20, True),
    small("revision_number", True),
    small("order_quantity", True),
    money("unit_price", True),
    money("extended_amount", True),
    real("unit_price_discount_pct", True, default=0.0),
    real("discount_amount", True, default=0.0),
    money("product_standard_cost", True),
    money("total_product_cost", True),
    money("sales_amount", True),
    money("tax_amt", True),
    money("freight", True),
    text("carrier_tracking_number", 25),
)

FACT_INTERNET_SALES = Table(
    "fact_internet_sales",
    "fact_internet_sales_key",
    (
        integer("sales_order_detail_id", True),
        long("product_key", True),
        integer("order_date_key", True),
        integer("due_date_key", True),
        integer("ship_date_key", True),
        long("customer_key", True),
        long("promotion_key", True),
        long("currency_key", True),
        integer("sales_territory_key", True),
        *_SALE_MEASURES,
    ),
    unique=(("sales_order_number", "sales_order_detail_id"),),
)

FACT_RESELLER_SALES = Table(
    "fact_reseller_sales",
    "fact_reseller_sales_key",
    (
        integer("sales_order_detail_id", True),
        long("product_key", True),
        integer("order_date_key", True),
        integer("due_date_key", True),
        integer("ship_date_key", True),
        long("reseller_key", True),
        long("employee_key", True),
        long("promotion_key", True),
        long("currency_key", True),
        integer("sales_territory_key", True),
        *_SALE_MEASURES,
    ),
    unique=(("sales_order_number", "sales_order_detail_id"),),
)

# Every target table, parents before children.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        DIM_DATE,
        DIM_CURRENCY,
        DIM_SALES_TERRITORY,
        DIM_GEOGRAPHY,
        DIM_PROMOTION,
        DIM_SALES_REASON,
        DIM_PRODUCT_CATEGORY,
        DIM_PRODUCT_SUBCATEGORY,
        DIM_PRODUCT,
        DIM_CUSTOMER,
        DIM_RESELLER,
        DIM_EMPLOYEE,
        FACT_INTERNET_SALES,
        FACT_RESELLER_SALES,
    )
}
DIMENSIONS = [name for name, t in TABLES.items() if not t.is_fact]
FACTS = [name for name, t in TABLES.items() if t.is_fact]

FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    ForeignKey("fk_geography_salesterritory", "dim_geography", "sales_territory_key", "dim_sales_territory"),
    ForeignKey("fk_productsubcat_category", "dim_product_subcategory", "product_category_key", "dim_product_category"),
    ForeignKey("fk_product_subcategory", "dim_product", "product_subcategory_key", "dim_product_subcategory"),
    ForeignKey("fk_customer_geography", "dim_customer", "geography_key", "dim_geography"),
    ForeignKey("fk_reseller_geography", "dim_reseller", "geography_key", "dim_geography"),
    ForeignKey("fk_fis_currency", "fact_internet_sales", "currency_key", "dim_currency"),
    ForeignKey("fk_fis_customer", "fact_internet_sales", "customer_key", "dim_customer", decides=True),
    ForeignKey("fk_fis_orderdate", "fact_internet_sales", "order_date_key", "dim_date", decides=True),
    ForeignKey("fk_fis_duedate", "fact_internet_sales", "due_date_key", "dim_date"),
    ForeignKey("fk_fis_shipdate", "fact_internet_sales", "ship_date_key", "dim_date"),
    ForeignKey("fk_fis_product", "fact_internet_sales", "product_key", "dim_product", decides=True),
    ForeignKey("fk_fis_promotion", "fact_internet_sales", "promotion_key", "dim_promotion"),
    ForeignKey("fk_fis_salesterritory", "fact_internet_sales", "sales_territory_key", "dim_sales_territory"),
    ForeignKey("fk_frs_currency", "fact_reseller_sales", "currency_key", "dim_currency"),
    ForeignKey("fk_frs_orderdate", "fact_reseller_sales", "order_date_key", "dim_date"),
    ForeignKey("fk_frs_duedate", "fact_reseller_sales", "due_date_key", "dim_date"),
    ForeignKey("fk_frs_shipdate", "fact_reseller_sales", "ship_date_key", "dim_date"),
    ForeignKey("fk_frs_employee", "fact_reseller_sales", "employee_key", "dim_employee", decides=True),
    ForeignKey("fk_frs_product", "fact_reseller_sales", "product_key", "dim_product", decides=True),
    ForeignKey("fk_frs_promotion", "fact_reseller_sales", "promotion_key", "dim_promotion"),
    ForeignKey("fk_frs_reseller", "fact_reseller_sales", "reseller_key", "dim_reseller", decides=True),
    ForeignKey("fk_frs_salesterritory", "fact_reseller_sales", "sales_territory_key", "dim_sales_territory"),
)


# The columns by which rows of a table are looked up, facts by most of their keys.
LOOKUP_COLUMNS: dict[str, tuple[str, ...]] = {
    "fact_internet_sales": (
        "order_date_key", "customer_key", "product_key", "ship_date_key", "promotion_key", "currency_key",
    ),
    "fact_reseller_sales": (
        "order_date_key", "reseller_key", "product_key", "ship_date_key", "employee_key", "promotion_key",
    ),
    "dim_customer": ("geography_key",),
    "dim_reseller": ("geography_key",),
    "dim_product": ("product_subcategory_key",),
    "dim_product_subcategory": ("product_category_key",),
}


def parents_of(table: str) -> list[str]:
    return sorted({fk.parent for fk in FOREIGN_KEYS if fk.child == table})


def dependants_of(table: str) -> list[str]:
    """Every table that refers to ``table``, directly or through another table."""
    found: list[str] = []
    queue = [table]
    while queue:
        parent = queue.pop()
        for fk in FOREIGN_KEYS:
            if fk.parent == parent and fk.child not in found:
                found.append(fk.child)
                queue.append(fk.child)
    return [name for name in TABLES if name in found]


def load_order(names: Iterable[str] | None = None) -> list[list[str]]:
    """Tables grouped into waves; each wave needs only tables of earlier waves."""
    wanted = set(names) if names is not None else set(TABLES)
    waves: list[list[str]] = []
    done: set[str] = set()
    while done < wanted:
        wave = [n for n in TABLES if n in wanted - done and not (set(parents_of(n)) & wanted) - done]
        waves.append(wave)
        done |= set(wave)
    return waves


def apply_defaults(df: DataFrame, table: Table) -> DataFrame:
    """Add a column's default where the input lacks the column.

    An explicit null stays null: it is for the not-null check to report.
    """
    absent = {
        c.name: F.lit(c.default).cast(c.type)
        for c in table.columns
        if c.default is not None and c.name not in df.columns
    }
    return df.withColumns(absent) if absent else df


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Project ``df`` to the columns and types of ``table``.

    Absent columns become null (or their default); unknown columns are an error.
    The generated key is kept when present.
    """
    known = {c.name for c in table.columns} | {table.key}
    unknown = [c for c in df.columns if c not in known]
    if unknown:
        raise ValueError(f"{table.name} has no column {unknown}")
    df = apply_defaults(df, table)
    present = set(df.columns)
    key = [table.key] if table.generated and table.key in present else []
    wanted = key + [c.name for c in table.columns]
    return df.selectExpr(
        *[f"cast({c if c in present else 'null'} as {table.column_types[c]}) as {c}" for c in wanted]
    )

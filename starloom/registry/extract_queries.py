"""Scans and extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import extracts
from ..plans.checks import named_counts, total_rows
from ..plans.dimensions import dim_date, dim_sales_territory
from ..plans.preflight import source_report
from ..session import new_folder
from ..sources.flat_files import CALENDAR_FILE_COLUMNS, read_calendar_csv, read_territory_csv
from ..sources.tables import FrameSource, ParquetSource, read_tables
from .catalog import query
from .loaded import loaded_dimensions
from .source_views import AS_OF, BenchmarkTables, calendar_rows, sales_source, territory_rows


@query(
    """select (select count(*) from customer) as customers, (select count(*) from part) as products,
              (select count(*) from orders) as orders, (select count(*) from lineitem) as order_lines"""
)
def multi_table_scan(spark: SparkSession, folder: str) -> DataFrame:
    names = ["customer.parquet", "part.parquet", "orders.parquet", "lineitem.parquet"]
    frames = read_tables(ParquetSource(spark, folder), names)
    return named_counts(dict(zip(["customers", "products", "orders", "order_lines"], frames, strict=True)))


def _register(name: str, sql: str, build) -> None:
    query(sql, name)(lambda spark, folder: build(sales_source(spark, folder)))


_register("currency_extract", "select * from x_currency", extracts.extract_dim_currency)
_register("geography_extract", "select * from x_geography", extracts.extract_dim_geography)
_register("customer_extract", "select * from x_customer", extracts.extract_dim_customer)
_register("product_category_extract", "select * from x_category", extracts.extract_dim_product_category)
_register("product_subcategory_extract", "select * from x_subcategory", extracts.extract_dim_product_subcategory)
_register("product_extract", "select * from x_product", extracts.extract_dim_product)
_register("promotion_extract", "select * from x_promotion", extracts.extract_dim_promotion)
_register("sales_reason_extract", "select * from x_reason", extracts.extract_dim_sales_reason)
_register("reseller_extract", "select * from x_reseller", extracts.extract_dim_reseller)
_register("employee_extract", "select * from x_employee", lambda source: extracts.extract_dim_employee(source, AS_OF))


def _snake_dates(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(
        {
            "OrderDate": "order_date",
            "DueDate": "due_date",
            "ShipDate": "ship_date",
            "SalesOrderNumber": "sales_order_number",
        }
    )


_register(
    "internet_sales_extract",
    "select * from x_internet",
    lambda source: _snake_dates(extracts.extract_fact_internet_sales(source)),
)
_register(
    "reseller_sales_extract",
    "select * from x_reseller_sales",
    lambda source: _snake_dates(extracts.extract_fact_reseller_sales(source)),
)


@query(
    """select 'dim_currency' as table_name, 'failed' as status, 0 as row_count
       union all select 'dim_geography', 'extracted', (select count(*) from x_geography)
       union all select 'dim_customer', 'extracted', (select count(*) from x_customer)
       union all select 'dim_product_category', 'extracted', (select count(*) from x_category)
       union all select 'dim_product_subcategory', 'extracted', (select count(*) from x_subcategory)
       union all select 'dim_product', 'extracted', (select count(*) from x_product)
       union all select 'dim_promotion', 'extracted', (select count(*) from x_promotion)
       union all select 'dim_sales_reason', 'extracted', (select count(*) from x_reason)
       union all select 'dim_reseller', 'extracted', (select count(*) from x_reseller)
       union all select 'dim_employee', 'extracted', (select count(*) from x_employee)
       union all select 'fact_internet_sales', 'extracted', (select count(*) from x_internet)
       union all select 'fact_reseller_sales', 'extracted', (select count(*) from x_reseller_sales)"""
)
def extraction_status(spark: SparkSession, folder: str) -> DataFrame:
    """Every extract, with the currency table missing from the source."""
    whole = sales_source(spark, folder)
    names = [n for n in whole.names if n != "Sales.Currency"]
    partial = FrameSource(spark, {n: (lambda n=n: whole.table(n)) for n in names})
    return extracts.extraction_report(spark, extracts.extract_all(partial, AS_OF))


@query(
    "select "
    + " + ".join(
        f"(select count(*) from {t})"
        for t in "x_currency x_geography x_customer x_category x_subcategory x_product x_promotion x_reason x_reseller "
        "x_employee x_internet x_reseller_sales d_date d_territory".split()
    )
    + " as total_rows"
)
def total_extracted_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the twelve extracts and the two files."""
    frames = extracts.extract_all(sales_source(spark, folder), AS_OF).frames
    return total_rows({**frames, "calendar": calendar_rows(spark, folder), "territories": territory_rows(spark, folder)})


@query("select * from d_date")
def calendar_file(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar written as its pipe-separated file and read back."""
    rows = calendar_rows(spark, folder)
    other_names = {
        c: F.col("month_name" if "month" in c else "day_name_of_week")
        for c in (f.split()[0] for f in CALENDAR_FILE_COLUMNS.split(", "))
        if c not in rows.columns
    }
    columns = [f.split()[0] for f in CALENDAR_FILE_COLUMNS.split(", ")]
    path = new_folder(spark, "calendar-file")
    rows.withColumns(other_names).select(*columns).write.csv(path, sep="|", header=False, encoding="UTF-8")
    return dim_date(read_calendar_csv(spark, path))


@query("select * from d_territory")
def territory_file(spark: SparkSession, folder: str) -> DataFrame:
    """The territories written as their UTF-16 file and read back."""
    rows = territory_rows(spark, folder)
    path = new_folder(spark, "territory-file")
    rows.select(F.col("sales_territory_alternate_key").alias("row_key"), *rows.columns).write.csv(
        path, sep="|", header=False, encoding="UTF-16"
    )
    return dim_sales_territory(read_territory_csv(spark, path))


@query("select d_promotion.*, true as is_present from d_promotion")
def dimension_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """A loaded dimension with its keys; a table that does not exist adds no rows."""
    warehouse, _ = loaded_dimensions(spark, folder)
    missing = type(warehouse)(spark, f"{warehouse.database}_absent").read("dim_promotion")
    return warehouse.read("dim_promotion").unionByName(missing).withColumn("is_present", F.lit(True))


@query(
    """select (select count(*) from s_customer) as customers, (select count(*) from s_product) as products,
              (select count(*) from s_header) as orders"""
)
def scalar_counts(spark: SparkSession, folder: str) -> DataFrame:
    source = sales_source(spark, folder)
    return named_counts(
        {
            "customers": source.table("Sales.Customer"),
            "products": source.table("Production.Product"),
            "orders": source.table("Sales.SalesOrderHeader"),
        }
    )


# What each source table is made of in the benchmark tables.
_SOURCE_ROWS = {
    "HumanResources.Department": "(select distinct event_type from events)",
    "HumanResources.Employee": "(select distinct user_id from events)",
    "HumanResources.EmployeeDepartmentHistory": "(select distinct user_id, event_type from events)",
    "HumanResources.EmployeePayHistory": "events",
    "Person.Address": "(select c_custkey from customer union all select s_suppkey from supplier)",
    "Person.BusinessEntityAddress": "(select c_custkey from customer cross join range(2) union all select s_suppkey from supplier)",
    "Person.CountryRegion": "region",
    "Person.EmailAddress": "(select c_custkey from customer cross join range(2))",
    "Person.Person": "customer",
    "Person.PersonPhone": "(select c_custkey from customer cross join range(2))",
    "Person.StateProvince": "nation",
    "Production.Product": "part",
    "Production.ProductCategory": "(select distinct p_type from part)",
    "Production.ProductDescription": "documents",
    "Production.ProductModel": "(select distinct p_partkey // 3 from part)",
    "Production.ProductModelProductDescriptionCulture": "documents",
    "Production.ProductSubcategory": "(select distinct p_brand, p_type from part)",
    "Sales.Currency": "region",
    "Sales.CurrencyRate": "nation",
    "Sales.Customer": "customer",
    "Sales.SalesOrderDetail": "lineitem",
    "Sales.SalesOrderHeader": "orders",
    "Sales.SalesReason": "(select distinct l_returnflag, l_linestatus from lineitem)",
    "Sales.SalesTerritory": "nation",
    "Sales.SpecialOffer": "(select distinct o_orderpriority from orders)",
    "Sales.Store": "supplier",
    "Sales.vStoreWithContacts": "customer",
}


@query(
    " union all ".join(
        f"select '{name}' as table_name, 'ok' as status, count(*) as row_count from {rows}" for name, rows in _SOURCE_ROWS.items()
    )
)
def source_probe(spark: SparkSession, folder: str) -> DataFrame:
    """Status and rows of every source table, as a run sees them before it starts."""
    return source_report(sales_source(spark, folder))


@query("select n_nationkey as nation_alternate_key, n_name as nation_name from nation")
def rename_projection(spark: SparkSession, folder: str) -> DataFrame:
    renamed = BenchmarkTables(spark, folder).nation.withColumnsRenamed(
        {"n_nationkey": "nation_alternate_key", "n_name": "nation_name"}
    )
    return renamed.drop("n_regionkey", "no_such_column")

"""Column steps: keys, dates, measures, codes, XML fields, simple dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import business_type
from ..functions.keys import (
    add_date_keys,
    coerce_whole_numbers,
    composite_key,
    fill_missing,
    normalize_key,
    text_alternate_keys,
    text_keys,
)
from ..functions.measures import derived_measures
from ..functions.xml_fields import PERSON_SURVEY, STORE_SURVEY, xml_fields
from ..model import DIM_EMPLOYEE, DIM_PRODUCT, FACT_INTERNET_SALES, apply_defaults, conform
from ..operators.history import current_rows, latest_rows
from ..plans import extracts
from ..plans.dimensions import dim_currency, dim_date, dim_geography, dim_sales_territory
from .catalog import query
from .source_views import AS_OF, BenchmarkTables, calendar_rows, sales_source, territory_rows


@query(
    """select p_partkey, case when p_type = 'PROMO' then '' else trim(concat('  ', p_brand, ' ')) end
              as product_alternate_key from part"""
)
def key_normalisation(spark: SparkSession, folder: str) -> DataFrame:
    """Padded and null product codes."""
    padded = BenchmarkTables(spark, folder).part.selectExpr(
        "p_partkey", "case when p_type <> 'PROMO' then concat('  ', p_brand, ' ') end as product_alternate_key"
    )
    return normalize_key(normalize_key(padded, "product_alternate_key"), "no_such_column")


@query(
    """select cast(customer_id as varchar) as customer_alternate_key, cast(territory as varchar)
              as sales_territory_alternate_key, order_id from s_header"""
)
def alternate_keys_as_text(spark: SparkSession, folder: str) -> DataFrame:
    header = sales_source(spark, folder).table("Sales.SalesOrderHeader")
    return text_alternate_keys(
        header.selectExpr(
            "CustomerID as customer_alternate_key", "TerritoryID as sales_territory_alternate_key", "SalesOrderID as order_id"
        )
    )


@query(
    """select cast(c_custkey as varchar) as customer_alternate_key, c_nationkey as nation_alternate_key
       from customer"""
)
def listed_keys_as_text(spark: SparkSession, folder: str) -> DataFrame:
    """Only the listed business keys become text."""
    customers = BenchmarkTables(spark, folder).customer
    return text_keys(
        customers.selectExpr("c_custkey as customer_alternate_key", "c_nationkey as nation_alternate_key")
    )


@query(
    """select order_id, cast(strftime(order_date, '%Y%m%d') as integer) as order_date_key,
              cast(strftime(due_date, '%Y%m%d') as integer) as due_date_key,
              cast(strftime(ship_date, '%Y%m%d') as integer) as ship_date_key from s_header"""
)
def order_date_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Date keys of a timestamp, a date text with unreadable values, and a nullable date."""
    header = sales_source(spark, folder).table("Sales.SalesOrderHeader")
    typed = header.selectExpr(
        "SalesOrderID as order_id",
        "OrderDate",
        "cast(DueDate as string) as DueDate",
        "coalesce(cast(ShipDate as string), 'not shipped') as ShipDate",
    )
    keys = {"OrderDate": "order_date_key", "DueDate": "due_date_key", "ShipDate": "ship_date_key", "Absent": "absent_key"}
    return add_date_keys(typed, keys).drop("OrderDate", "DueDate", "ShipDate")


@query(
    """select order_id, extended_amount, case when territory is null then 'Unknown' else 'Known' end as known,
              coalesce(code, 'USD') as currency_alternate_key
       from s_header join s_detail using (order_id) left join s_rate using (rate_id)"""
)
def null_filling(spark: SparkSession, folder: str) -> DataFrame:
    source = sales_source(spark, folder)
    lines = source.table("Sales.SalesOrderDetail").selectExpr("SalesOrderID as order_id", "LineTotal as extended_amount")
    header = source.table("Sales.SalesOrderHeader").selectExpr(
        "SalesOrderID as order_id", "CurrencyRateID", "case when TerritoryID is not null then 'Known' end as known"
    )
    joined = header.join(lines, "order_id").join(source.table("Sales.CurrencyRate"), "CurrencyRateID", "left")
    named = joined.withColumnRenamed("ToCurrencyCode", "currency_alternate_key").drop("CurrencyRateID")
    return fill_missing(fill_missing(named, ["currency_alternate_key", "absent"], "USD"), ["known"], "Unknown")


@query(
    """select l_orderkey, l_linenumber, l_partkey, cast(l_quantity as bigint) as quantity,
              cast(null as bigint) as flag,
              case when l_discount = 0 then cast(0 as bigint) end as discount, l_extendedprice from lineitem"""
)
def whole_number_coercion(spark: SparkSession, folder: str) -> DataFrame:
    """Text that is a whole number, text that is not a number, and fractions."""
    lines = BenchmarkTables(spark, folder).lineitem.selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "cast(l_quantity as string) as quantity",
        "l_returnflag as flag",
        "l_discount as discount",
        "l_extendedprice",
    )
    return coerce_whole_numbers(lines, ["quantity", "flag", "discount", "absent"])


@query(
    """select address_id, concat_ws('_', coalesce(city, 'Unknown'), state_province_code,
              coalesce(postal_code, 'Unknown')) as geo_match_key from s_located"""
)
def place_keys(spark: SparkSession, folder: str) -> DataFrame:
    """City, province and postal code joined into one key after null filling."""
    located = extracts.addresses(sales_source(spark, folder))
    parts = ["city", "state_province_code", "postal_code"]
    return fill_missing(located, parts, "Unknown").select(
        F.col("AddressID").alias("address_id"), composite_key(*parts).alias("geo_match_key")
    )


@query(
    """select order_id, sales_order_detail_id, unit_price, unit_price_discount_pct, extended_amount,
              standard_cost as product_standard_cost, order_quantity,
              unit_price * unit_price_discount_pct as discount_amount,
              cast(standard_cost * order_quantity as decimal(25,4)) as total_product_cost,
              extended_amount - unit_price * unit_price_discount_pct as sales_amount
       from s_detail join s_product using (part_key)"""
)
def sales_measures(spark: SparkSession, folder: str) -> DataFrame:
    details = extracts.order_details(sales_source(spark, folder)).withColumnRenamed("SalesOrderID", "order_id")
    return derived_measures(
        details.drop("product_alternate_key", "promotion_alternate_key", "carrier_tracking_number")
    )


@query(
    """select order_id, sales_order_detail_id, unit_price, extended_amount, 0.0::double as discount_amount,
              0.0::double as total_product_cost, extended_amount as sales_amount
       from s_detail"""
)
def measures_without_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """Absent discount, cost and quantity count as zero."""
    lines = sales_source(spark, folder).table("Sales.SalesOrderDetail").selectExpr(
        "SalesOrderID as order_id",
        "SalesOrderDetailID as sales_order_detail_id",
        "UnitPrice as unit_price",
        "LineTotal as extended_amount",
    )
    return derived_measures(lines)


@query(
    """select cast(product_alternate_key as varchar) as product_alternate_key, product_name,
              false as finished_goods_flag from x_product"""
)
def product_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """The default of a column the input lacks."""
    raw = extracts.extract_dim_product(sales_source(spark, folder)).select("product_alternate_key", "product_name")
    return apply_defaults(text_keys(raw), DIM_PRODUCT)


@query(
    """select entity_id as employee_alternate_key, hire_date, false as name_style,
              case when sick_leave_hours > 15 then current_flag end as current_flag from s_employee"""
)
def employee_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """An explicit null is kept although the column has a default."""
    raw = sales_source(spark, folder).table("HumanResources.Employee").selectExpr(
        "BusinessEntityID as employee_alternate_key",
        "HireDate as hire_date",
        "case when SickLeaveHours > 15 then CurrentFlag end as current_flag",
    )
    return apply_defaults(raw, DIM_EMPLOYEE)


@query(
    """select order_id as fact_internet_sales_key, sales_order_detail_id, order_quantity,
              cast(unit_price_discount_pct as double) as unit_price_discount_pct, 0.0::double as discount_amount,
              cast(standard_cost as decimal(19,4)) as product_standard_cost, cast(null as integer) as order_date_key
       from s_detail join s_product using (part_key)"""
)
def target_types(spark: SparkSession, folder: str) -> DataFrame:
    """Lines projected to the fact's columns and types; absent columns become null or their default."""
    details = extracts.order_details(sales_source(spark, folder)).select(
        F.col("SalesOrderID").alias("fact_internet_sales_key"),
        "sales_order_detail_id",
        "order_quantity",
        "unit_price_discount_pct",
        "product_standard_cost",
    )
    return conform(details, FACT_INTERNET_SALES).select(*details.columns, "discount_amount", "order_date_key")


@query(
    """select s_suppkey, s_name, case s_nationkey % 6 when 0 then 'Bike Manufacturer' when 1 then 'Bike Shop'
              when 2 then 'Online Store' when 3 then 'Value Added Reseller' when 4 then 'Other shop'
              else 'Value Added Reseller' end as business_type from supplier"""
)
def business_type_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Known, unknown and missing codes."""
    coded = BenchmarkTables(spark, folder).supplier.selectExpr(
        "s_suppkey",
        "s_name",
        "case s_nationkey % 6 when 0 then 'BM' when 1 then 'BS' when 2 then 'OS' when 3 then 'VARS' "
        "when 4 then 'Other shop' end as code",
    )
    return coded.withColumn("business_type", business_type(F.col("code"))).drop("code")


@query("select * from s_survey")
def person_survey_fields(spark: SparkSession, folder: str) -> DataFrame:
    people = sales_source(spark, folder).table("Person.Person").selectExpr("BusinessEntityID as entity_id", "Demographics")
    return xml_fields(people, "Demographics", PERSON_SURVEY)


@query(
    """select 2 * s_suppkey + 1 as entity_id,
              case when s_nationkey <> 7 then case s_nationkey % 6 when 0 then 'BM' when 1 then 'BS' when 2 then 'OS'
                   when 3 then 'WS' when 4 then 'VARS' else 'Kiosk and market stall' end end as business_code,
              s_nationkey * 3 + 1 as number_employees, cast(s_acctbal as decimal(19,4)) as annual_sales,
              concat('Bank of ', s_nationkey) as bank_name,
              case when s_nationkey <> 9 then cast(s_acctbal as decimal(19,4)) end as annual_revenue,
              case when s_nationkey <> 5 then 1950 + s_nationkey end as year_opened
       from supplier"""
)
def store_survey_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The same documents with a namespace prefix on every element."""
    stores = sales_source(spark, folder).table("Sales.Store").selectExpr(
        "BusinessEntityID as entity_id",
        r"regexp_replace(replace(Demographics, 'xmlns=', 'xmlns:ns='), '<(/?)([A-Z])', '<$1ns:$2') as Demographics",
    )
    return xml_fields(stores, "Demographics", STORE_SURVEY, prefix="ns")


def _lost_sql() -> str:
    """Each survey column with the texts that are too long for it and the values that are not of its type."""
    surveyed = "c_mktsegment <> 'FURNITURE' or c_acctbal >= 1000"
    none, every = "false", "true"
    people = {
        "birth_date": (every, none, none),
        "marital_status": (every, "c_nationkey < 10", none),
        "gender": (every, none, none),
        "yearly_income": (every, "length(concat(c_nationkey * 1000, '-', c_nationkey * 1000 + 25000, ' per year')) > 20", none),
        "total_children": (every, none, "c_mktsegment = 'BUILDING'"),
        "number_children_at_home": ("c_nationkey <= 20", none, none),
        "education": (every, none, none),
        "house_owner_flag": (every, none, none),
        "number_cars_owned": (every, none, none),
        "date_first_purchase": (every, none, none),
        "commute_distance": (every, "length(concat(c_nationkey, ' miles and some more')) > 20", none),
    }
    stores = {
        "business_code": ("s_nationkey <> 7", none, none),
        "number_employees": (every, none, none),
        "annual_sales": (every, none, none),
        "bank_name": (every, none, none),
        "annual_revenue": ("s_nationkey <> 9", none, none),
        "year_opened": (every, none, "s_nationkey = 5"),
    }
    return " union all ".join(
        f"select '{name}' as table_name, '{c}' as column_name, count(*) filter ({filled}) as filled, "
        f"count(*) filter ({cut}) as cut, count(*) filter ({bad}) as unreadable from {table} where {kept}"
        for name, table, kept, columns in (
            ("dim_customer", "customer", surveyed, people),
            ("dim_reseller", "supplier", every, stores),
        )
        for c, (filled, cut, bad) in columns.items()
    )


@query(_lost_sql())
def lost_survey_values(spark: SparkSession, folder: str) -> DataFrame:
    """Survey texts cut to their width and values that are not of their type, for each column."""
    return extracts.lost_survey_values(sales_source(spark, folder))


@query("select * from d_date")
def calendar_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return dim_date(calendar_rows(spark, folder))


@query("select * from d_territory")
def territory_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return dim_sales_territory(territory_rows(spark, folder))


@query("select coalesce(nullif(currency_alternate_key, 'ASI'), 'USD') as currency_alternate_key, currency_name from x_currency")
def currency_without_code(spark: SparkSession, folder: str) -> DataFrame:
    """A currency without a code takes the default code."""
    raw = extracts.extract_dim_currency(sales_source(spark, folder))
    return dim_currency(raw.withColumn("currency_alternate_key", F.expr("nullif(currency_alternate_key, 'ASI')")))


@query("select * exclude (geography_key) from d_geography")
def geography_with_unknown(spark: SparkSession, folder: str) -> DataFrame:
    return dim_geography(extracts.extract_dim_geography(sales_source(spark, folder)))


@query("select entity_id, department_name, start_date, end_date from x_department")
def current_departments(spark: SparkSession, folder: str) -> DataFrame:
    source = sales_source(spark, folder)
    history = source.table("HumanResources.EmployeeDepartmentHistory")
    return (
        current_rows(history, "EndDate", AS_OF)
        .join(source.table("HumanResources.Department"), "DepartmentID")
        .selectExpr("BusinessEntityID as entity_id", "Name as department_name", "StartDate as start_date", "EndDate as end_date")
    )


@query("select entity_id, rate, frequency from x_pay")
def latest_pay(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.latest_pay(sales_source(spark, folder)).toDF("entity_id", "rate", "frequency")


@query(
    """select user_id, event_id, event_type, cast(ts as date) as day from events e
       where cast(ts as date) = (select max(cast(ts as date)) from events l where l.user_id = e.user_id)"""
)
def last_day_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every event of each user's last day: ties keep all rows."""
    events = BenchmarkTables(spark, folder).events.withColumn("day", F.to_date("ts"))
    return latest_rows(events, ["user_id"], "day").select("user_id", "event_id", "event_type", "day")


@query("select model, description from x_description")
def localized_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.model_descriptions(sales_source(spark, folder)).toDF("model", "description")


@query(
    """select online, count(*) as order_count, cast(sum(revision_number) as bigint) as revisions
       from s_header where online is not null group by online"""
)
def channel_split(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per channel; an order without a channel flag is in neither."""
    source = sales_source(spark, folder)
    sides = [extracts.order_headers_of(source, online).withColumn("online", F.lit(online)) for online in (True, False)]
    return (
        sides[0]
        .unionByName(sides[1])
        .groupBy("online")
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("RevisionNumber").alias("revisions"))
    )


@query(
    """select count(*) as line_count from orders join lineitem on l_orderkey = o_orderkey
       where o_orderdate >= timestamp '1998-01-01'"""
)
def lines_since(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines since a date, counted."""
    return extracts.order_line_count(sales_source(spark, folder), "1998-01-01")

"""Lookups, deduplication, keys and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import add_date_keys
from ..model import DIM_GEOGRAPHY, conform
from ..operators.dedupe import duplicate_keys, duplicates_counted, keep_first, summary_of
from ..operators.lookup import (
    lookup_composite,
    lookup_date,
    lookup_key,
    lookup_with_default,
    orphans,
    validated_join,
    with_match_marker,
)
from ..operators.statistics import match_statistics
from ..operators.surrogate import assign_keys, unique_row_keys
from ..plans import extracts
from ..plans.dimensions import (
    PLACE_KEY,
    dim_customer,
    dim_geography,
    dim_product,
    dim_product_subcategory,
    dim_reseller,
    dim_sales_territory,
    territory_matches,
    unknown_place_key,
)
from ..plans.facts import (
    FACT_PLANS,
    INTERNET_SALES,
    RESELLER_SALES,
    FactPlan,
    build_fact,
    fact_internet_sales,
    fact_reseller_sales,
    incomplete_rows,
    resolve_fact_from_source,
)
from .catalog import query
from .loaded import loaded_dimensions
from .source_views import BenchmarkTables, calendar_rows, sales_source, territory_rows


def _dims(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return loaded_dimensions(spark, folder)[0].tables()


def _geography(spark: SparkSession, folder: str) -> DataFrame:
    """The geography dimension with keys."""
    rows = conform(dim_geography(extracts.extract_dim_geography(sales_source(spark, folder))), DIM_GEOGRAPHY)
    return assign_keys(rows, "geography_key", DIM_GEOGRAPHY.order_by)


@query("select entity_id, email_address, phone from x_contacts")
def person_contacts(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.person_contacts(sales_source(spark, folder)).withColumnRenamed("BusinessEntityID", "entity_id")


@query("select * from x_addresses")
def entity_addresses(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.entity_addresses(sales_source(spark, folder)).withColumnRenamed("BusinessEntityID", "entity_id")


@query(
    """select entity_id, l.* exclude (address_id) from s_entity_address
       left join s_located l using (address_id)
       qualify row_number() over (partition by entity_id order by address_id desc) = 1"""
)
def entity_addresses_whole(spark: SparkSession, folder: str) -> DataFrame:
    """One real address per entity instead of the greatest value of each column."""
    return extracts.entity_addresses(sales_source(spark, folder), whole_address=True).withColumnRenamed(
        "BusinessEntityID", "entity_id"
    )


_FINISHED = "select row_number() over (order by p_partkey) as product_key, p_partkey from part where p_type <> 'PROMO'"


def _finished_goods(spark: SparkSession, folder: str) -> DataFrame:
    goods = BenchmarkTables(spark, folder).part.where("p_type <> 'PROMO'").selectExpr("p_partkey as product_alternate_key")
    return assign_keys(goods, "product_key", ["product_alternate_key"])


@query(
    f"""select l_orderkey, l_linenumber, l_extendedprice, product_key
        from lineitem left join ({_FINISHED}) on p_partkey = l_partkey"""
)
def product_key_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines against finished goods only, so some lines find no product."""
    lines = BenchmarkTables(spark, folder).lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_extendedprice", "cast(l_partkey as string) as product_alternate_key"
    )
    dim = _finished_goods(spark, folder)
    return lookup_key(lines, dim, "product_alternate_key", "product_alternate_key", "product_key")


def _statistics_sql(fact: str, own: str) -> str:
    keys = f"{own} currency_key sales_territory_key product_key promotion_key order_date_key due_date_key ship_date_key".split()
    return f"""
       select lookup, total_rows, matched, total_rows - matched as unmatched,
              matched * 100.0::double / total_rows as match_percent,
              case when matched = 0 then 'error' when total_rows - matched > total_rows * 0.1 then 'warning'
                   else 'ok' end as severity
       from (unpivot (select count(*) as total_rows, {", ".join(f"count({k}) as {k}" for k in keys)} from {fact})
             on {", ".join(keys)} into name lookup value matched)"""


def _statistics(spark: SparkSession, folder: str, plan: FactPlan) -> DataFrame:
    resolved = resolve_fact_from_source(sales_source(spark, folder), _dims(spark, folder), plan)
    return match_statistics(resolved, plan.resolved_keys)


@query(_statistics_sql("f_internet", "customer_key"))
def lookup_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Match statistics of every lookup of the internet fact, in one pass."""
    return _statistics(spark, folder, INTERNET_SALES)


@query(_statistics_sql("f_reseller", "reseller_key employee_key"))
def reseller_lookup_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Match statistics of every lookup of the reseller fact, in one pass."""
    return _statistics(spark, folder, RESELLER_SALES)


@query(
    """select order_id, od.date_key as order_date_key, dd.date_key as due_date_key, sd.date_key as ship_date_key
       from s_header left join d_date od on od.full_date_alternate_key = cast(order_date as date)
       left join d_date dd on dd.full_date_alternate_key = cast(due_date as date)
       left join d_date sd on sd.full_date_alternate_key = cast(ship_date as date)"""
)
def date_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Three roles of one calendar; dates beyond it give null."""
    header = sales_source(spark, folder).table("Sales.SalesOrderHeader").selectExpr(
        "SalesOrderID as order_id", "OrderDate", "DueDate", "ShipDate"
    )
    calendar = calendar_rows(spark, folder)
    keyed = add_date_keys(header, {"OrderDate": "k1", "DueDate": "k2", "ShipDate": "k3"}).drop(
        "OrderDate", "DueDate", "ShipDate"
    )
    for temporary, final in (("k1", "order_date_key"), ("k2", "due_date_key"), ("k3", "ship_date_key")):
        keyed = lookup_date(keyed, calendar, temporary, final)
    return keyed


@query(
    """select count(*) filter (t.sales_territory_key is not null) as matched,
              count(*) filter (t.sales_territory_key is null) as unmatched
       from x_geography left join (select * from d_territory where sales_territory_country <> 'ASIA') t
         using (sales_territory_key)"""
)
def territory_match_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Places with and without a known territory, one country's territories being unknown."""
    places = extracts.extract_dim_geography(sales_source(spark, folder))
    known = dim_sales_territory(territory_rows(spark, folder)).where("sales_territory_country <> 'ASIA'")
    return territory_matches(places, known)


@query(
    """select g.*, t.sales_territory_key is not null as is_matched from x_geography g
       left join (select sales_territory_key from d_territory where sales_territory_country <> 'ASIA') t
         using (sales_territory_key)"""
)
def territory_match_marker(spark: SparkSession, folder: str) -> DataFrame:
    places = extracts.extract_dim_geography(sales_source(spark, folder))
    known = dim_sales_territory(territory_rows(spark, folder)).where("sales_territory_country <> 'ASIA'")
    return with_match_marker(places, known, "sales_territory_key")


@query(
    """select customer_alternate_key, coalesce(x_customer.postal_code, 'Unknown') as postal_code,
              coalesce(geography_key, 10) as geography_key
       from x_customer left join (select postal_code, min(geography_key) as geography_key from d_geography
                                  where country_region_code <> 'EUR' group by postal_code) g
         on coalesce(x_customer.postal_code, 'Unknown') = g.postal_code"""
)
def default_member_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Customers against the places outside one country, misses taking a literal key."""
    customers = extracts.extract_dim_customer(sales_source(spark, folder)).select("customer_alternate_key", "postal_code")
    places = _geography(spark, folder).where("country_region_code <> 'EUR'")
    return lookup_with_default(customers, places, "postal_code", "geography_key", default=10)


@query(
    """select reseller_alternate_key, coalesce(r.city, 'Unknown') as city,
              coalesce(r.state_province_code, 'Unknown') as state_province_code,
              coalesce(r.postal_code, 'Unknown') as postal_code, geography_key
       from d_first_reseller r left join d_place p
         on coalesce(r.city, 'Unknown') = p.city and coalesce(r.postal_code, 'Unknown') = p.postal_code
        and coalesce(r.state_province_code, 'Unknown') = p.state_province_code"""
)
def composite_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Resellers against places on three columns; a miss stays null."""
    return lookup_composite(_first_resellers(spark, folder), _geography(spark, folder), PLACE_KEY, "geography_key")


@query(
    """select reseller_alternate_key, coalesce(r.city, 'Unknown') as city,
              coalesce(r.state_province_code, 'Unknown') as state_province_code,
              coalesce(r.postal_code, 'Unknown') as postal_code, geography_key
       from d_first_reseller r left join d_geography p
         on coalesce(r.city, 'Unknown') = p.city and coalesce(r.postal_code, 'Unknown') = p.postal_code
        and coalesce(r.state_province_code, 'Unknown') = p.state_province_code"""
)
def composite_lookup_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    """The same lookup keeping every place of a key."""
    return lookup_composite(
        _first_resellers(spark, folder), _geography(spark, folder), PLACE_KEY, "geography_key", fan_out=True
    )


def _first_resellers(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.first_resellers(sales_source(spark, folder)).select("reseller_alternate_key", *PLACE_KEY)


@query("select * from d_first_reseller")
def first_reseller_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The first row of each store among its addresses."""
    raw = extracts.resellers_by_address(sales_source(spark, folder))
    return keep_first(raw, ["reseller_alternate_key"], extracts.RESELLER_ORDER)


@query("select * from d_first_reseller")
def first_resellers_from_source(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows without pairing every phone with every address."""
    return extracts.first_resellers(sales_source(spark, folder))


@query(
    """select product_subcategory_alternate_key, product_subcategory_name, product_category_key
       from x_subcategory left join d_category using (product_category_alternate_key)"""
)
def subcategory_with_category_key(spark: SparkSession, folder: str) -> DataFrame:
    categories = assign_keys(
        extracts.extract_dim_product_category(sales_source(spark, folder)),
        "product_category_key",
        ["product_category_alternate_key"],
    )
    return dim_product_subcategory(extracts.extract_dim_product_subcategory(sales_source(spark, folder)), categories)


@query("select product_alternate_key, product_subcategory_key, product_name from d_product")
def product_with_subcategory_key(spark: SparkSession, folder: str) -> DataFrame:
    source = sales_source(spark, folder)
    subcategories = assign_keys(
        extracts.extract_dim_product_subcategory(source),
        "product_subcategory_key",
        ["product_subcategory_alternate_key"],
    )
    products = extracts.extract_dim_product(source).withColumn(
        "product_alternate_key", F.col("product_alternate_key").cast("string")
    )
    return dim_product(products, subcategories).select("product_alternate_key", "product_subcategory_key", "product_name")


@query("select cast(customer_alternate_key as bigint) as customer_alternate_key, geography_key, last_name from d_customer")
def customer_with_place_key(spark: SparkSession, folder: str) -> DataFrame:
    places = _geography(spark, folder)
    raw = extracts.extract_dim_customer(sales_source(spark, folder))
    return dim_customer(raw, places, unknown_place_key(places)).select(
        "customer_alternate_key", "geography_key", "last_name"
    )


@query("select cast(reseller_alternate_key as bigint) as reseller_alternate_key, geography_key, phone from d_reseller")
def reseller_with_place_key(spark: SparkSession, folder: str) -> DataFrame:
    places = _geography(spark, folder)
    raw = extracts.first_resellers(sales_source(spark, folder))
    return dim_reseller(raw, places, unknown_place_key(places)).select(
        "reseller_alternate_key", "geography_key", "phone"
    )


@query(
    """select l_orderkey, l_linenumber, count(*) as row_count, count(*) - 1 as surplus from lineitem
       group by l_orderkey, l_linenumber having count(*) > 1"""
)
def duplicate_line_keys(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(BenchmarkTables(spark, folder).lineitem, ["l_orderkey", "l_linenumber"])


@query(
    """select count(*) as duplicated_keys, cast(sum(n) as bigint) as rows_sharing_a_key,
              cast(sum(n - 1) as bigint) as surplus_rows
       from (select count(*) as n from x_reseller group by reseller_alternate_key having count(*) > 1)"""
)
def duplicate_reseller_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Stores that the reseller extract repeats, from the counts of their contacts."""
    return summary_of(duplicates_counted(extracts.reseller_row_counts(sales_source(spark, folder))))


@query("select order_id, customer_id, person_id, store_id from s_header left join s_customer using (customer_id)")
def validated_customer_join(spark: SparkSession, folder: str) -> DataFrame:
    """A many-to-one join, checked to be one."""
    source = sales_source(spark, folder)
    orders = source.table("Sales.SalesOrderHeader").select("SalesOrderID", "CustomerID")
    joined = validated_join(orders, source.table("Sales.Customer"), ["CustomerID"], "left", "m:1")
    return joined.toDF("customer_id", "order_id", "person_id", "store_id")


@query(
    f"""select l_orderkey, l_linenumber, l_partkey from lineitem
        where l_partkey not in (select p_partkey from ({_FINISHED}))"""
)
def orphan_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines of goods that are not in the product dimension."""
    t = BenchmarkTables(spark, folder)
    goods = t.part.where("p_type <> 'PROMO'")
    return orphans(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), goods, "l_partkey", "p_partkey")


@query("select o_orderkey, row_number() over (order by o_custkey, o_orderkey) as order_row_key from orders")
def ordered_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Dense keys over all orders, ordered by a repeated column and a tie-break."""
    orders = BenchmarkTables(spark, folder).orders.select("o_custkey", "o_orderkey")
    return assign_keys(orders, "order_row_key", ["o_custkey", "o_orderkey"]).drop("o_custkey")


@query("select count(*) as row_count, count(*) as distinct_keys, 1::bigint as first_key from lineitem")
def unique_line_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Gapped unique keys for fact rows, summarised."""
    keyed = unique_row_keys(BenchmarkTables(spark, folder).lineitem.select("l_orderkey"), "line_key")
    return keyed.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("line_key").alias("distinct_keys"),
        F.min("line_key").alias("first_key"),
    )


@query(
    """select count(*) as total_rows,
              count(*) filter (product_key is null or customer_key is null or order_date_key is null) as dropped_rows,
              count(*) filter (product_key is null) as missing_product_key,
              count(*) filter (customer_key is null) as missing_customer_key,
              count(*) filter (order_date_key is null) as missing_order_date_key
       from f_internet"""
)
def critical_key_losses(spark: SparkSession, folder: str) -> DataFrame:
    resolved = resolve_fact_from_source(sales_source(spark, folder), _dims(spark, folder), INTERNET_SALES)
    return incomplete_rows(resolved, INTERNET_SALES)


@query(
    """select count(*) as total_rows,
              count(*) filter (product_key is null or reseller_key is null or employee_key is null
                               or order_date_key is null) as dropped_rows,
              count(*) filter (product_key is null) as missing_product_key,
              count(*) filter (reseller_key is null) as missing_reseller_key,
              count(*) filter (employee_key is null) as missing_employee_key,
              count(*) filter (order_date_key is null) as missing_order_date_key
       from f_reseller"""
)
def reseller_key_losses(spark: SparkSession, folder: str) -> DataFrame:
    resolved = resolve_fact_from_source(sales_source(spark, folder), _dims(spark, folder), RESELLER_SALES)
    return incomplete_rows(resolved, RESELLER_SALES)


def _fact(table: str):
    def build(spark: SparkSession, folder: str) -> DataFrame:
        return build_fact(sales_source(spark, folder), _dims(spark, folder), FACT_PLANS[table])

    return build


# The internet fact holds its resolved keys as wide whole numbers.
_INTERNET_SQL = """
    select * replace (cast(sales_territory_key as bigint) as sales_territory_key,
                      cast(order_date_key as bigint) as order_date_key,
                      cast(due_date_key as bigint) as due_date_key,
                      cast(ship_date_key as bigint) as ship_date_key)
    from f_internet_kept"""

query(_INTERNET_SQL, "fact_internet_sales")(_fact(INTERNET_SALES.table))
query("select * from f_reseller_kept", "fact_reseller_sales")(_fact(RESELLER_SALES.table))


@query(_INTERNET_SQL)
def internet_sales_from_extract(spark: SparkSession, folder: str) -> DataFrame:
    """The internet fact from extracted lines instead of from the source tables."""
    lines = extracts.extract_fact_internet_sales(sales_source(spark, folder))
    return fact_internet_sales(lines, _dims(spark, folder))


@query("select * from f_reseller_kept")
def reseller_sales_from_extract(spark: SparkSession, folder: str) -> DataFrame:
    lines = extracts.extract_fact_reseller_sales(sales_source(spark, folder))
    return fact_reseller_sales(lines, _dims(spark, folder))

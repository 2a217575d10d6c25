"""Loads and the checks that follow them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import text_keys
from ..model import DIMENSIONS, FACTS, LOOKUP_COLUMNS, TABLES
from ..operators import integrity
from ..plans import checks, extracts
from ..plans.run import run
from ..plans.warehouse import ConstraintError
from .catalog import query
from .loaded import loaded_dimensions, loaded_warehouse, new_warehouse, prepared_dimensions
from .oracle_tables import LOADED
from .source_views import AS_OF, calendar_rows, sales_source, territory_rows


def _register_dimension(table: str) -> None:
    @query(f"select * from {LOADED[table]}", f"loaded_{table}")
    def read(spark: SparkSession, folder: str) -> DataFrame:
        return loaded_dimensions(spark, folder)[0].read(table)


for _name in DIMENSIONS:
    _register_dimension(_name)


def _counts_sql(tables: list[str]) -> str:
    return " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {LOADED[t]}" for t in tables)


@query(_counts_sql(DIMENSIONS))
def dimension_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Rows each dimension load reported."""
    _, rows = loaded_dimensions(spark, folder)
    return spark.createDataFrame(list(rows.items()), "table_name string, row_count bigint")


@query(_counts_sql(["fact_internet_sales", "fact_reseller_sales"]))
def fact_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Rows each fact load reported."""
    _, _, rows = loaded_warehouse(spark, folder)
    return spark.createDataFrame(list(rows.items()), "table_name string, row_count bigint")


# A stored amount is the value as it is written, rounded half up to four places.
_AMOUNTS = ", ".join(
    f"cast(cast({c} as varchar) as decimal(19,4)) as {c}"
    for c in "unit_price extended_amount total_product_cost sales_amount tax_amt freight".split()
)
_STORED = f"""sales_order_number, sales_order_detail_id, product_key, promotion_key, currency_key, sales_territory_key,
              order_date_key, due_date_key, ship_date_key, order_quantity, revision_number, product_standard_cost,
              carrier_tracking_number, unit_price_discount_pct, discount_amount, {_AMOUNTS}"""


@query(f"select customer_key, {_STORED} from f_internet_kept")
def loaded_internet_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Stored fact rows, every column but the generated key."""
    return loaded_warehouse(spark, folder)[0].read("fact_internet_sales").drop("fact_internet_sales_key")


@query(f"select reseller_key, employee_key, {_STORED} from f_reseller_kept")
def loaded_reseller_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Stored fact rows, every column but the generated key."""
    return loaded_warehouse(spark, folder)[0].read("fact_reseller_sales").drop("fact_reseller_sales_key")


@query(
    """select cast(order_date_key // 10000 as bigint) as calendar_year, count(*) as line_count,
              cast(sum(order_quantity) as bigint) as quantity,
              cast(sum(product_standard_cost * order_quantity) as decimal(28,4)) as cost
       from f_reseller_kept group by 1"""
)
def reseller_sales_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """Stored reseller lines summed per year."""
    warehouse, _, _ = loaded_warehouse(spark, folder)
    return (
        warehouse.read("fact_reseller_sales")
        .groupBy(F.expr("order_date_key div 10000").alias("calendar_year"))
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum("order_quantity").alias("quantity"),
            F.sum("total_product_cost").cast("decimal(28,4)").alias("cost"),
        )
    )


@query(
    """select n as first_load, n as second_load, 2 * n as after_append, n as reload, n as after_truncate,
              2 * n as last_appended_key
       from (select count(*) as n from x_reason)"""
)
def load_modes(spark: SparkSession, folder: str) -> DataFrame:
    """Append twice, then truncate and load again; keys continue on append."""
    warehouse = new_warehouse(spark, "modes")
    rows = extracts.extract_dim_sales_reason(sales_source(spark, folder))
    table = "dim_sales_reason"
    first, second = warehouse.load(table, rows), warehouse.load(table, rows)
    appended = warehouse.count(table)
    last_key = warehouse.read(table).agg(F.max("sales_reason_key").alias("k")).first()["k"]
    reload = warehouse.load(table, rows, truncate=True)
    counts = (first, second, appended, reload, warehouse.count(table), last_key)
    warehouse.drop()
    names = "first_load, second_load, after_append, reload, after_truncate, last_appended_key".split(", ")
    return spark.createDataFrame([counts], ", ".join(f"{n} bigint" for n in names))


_EMPTIED = "dim_geography dim_customer dim_reseller fact_internet_sales fact_reseller_sales".split()


@query(
    " union all ".join(
        f"select '{t}' as table_name, {'0::bigint' if t in _EMPTIED else f'(select count(*) from {LOADED[t]})'} as rows_left"
        for t in TABLES
    )
)
def cascading_truncate(spark: SparkSession, folder: str) -> DataFrame:
    """Emptying the places also empties who lives there and both facts, and nothing else."""
    warehouse = new_warehouse(spark, "cascade")
    for name, rows in loaded_warehouse(spark, folder)[0].tables().items():
        warehouse.append(name, rows, into_empty=True)
    warehouse.truncate("dim_geography")
    counts = [(name, warehouse.count(name)) for name in TABLES]
    warehouse.drop()
    return spark.createDataFrame(counts, "table_name string, rows_left bigint")


@query(
    " union all ".join(
        f"select '{t}' as table_name, true as is_present, count(*) as row_count, "
        f"case when count(*) > 0 then 'OK' else 'empty' end as status from {LOADED[t]}"
        for t in TABLES
    )
)
def table_report(spark: SparkSession, folder: str) -> DataFrame:
    return checks.table_report(spark, loaded_warehouse(spark, folder)[0].tables())


@query(
    """select 'dim_geography' as table_name, count(*) as total_rows, count(sales_territory_key) as matched
       from x_geography
       union all select 'dim_customer', count(*), count(*) filter (geography_key <> (select unknown_key from d_unknown))
       from d_customer
       union all select 'dim_reseller', count(*), count(*) filter (geography_key <> (select unknown_key from d_unknown))
       from d_reseller"""
)
def place_matches(spark: SparkSession, folder: str) -> DataFrame:
    """How many places, customers and resellers found their member."""
    return checks.place_matches(loaded_dimensions(spark, folder)[0].tables())


@query(f"select count(*) filter (row_count > 0) as matching, count(*) as total from ({_counts_sql(list(TABLES))})")
def tables_with_rows(spark: SparkSession, folder: str) -> DataFrame:
    """How many tables hold rows, of how many."""
    return checks.status_count(table_report(spark, folder))


# The expected foreign keys, not taken from the model: constraint, child, column, parent, its key, decides the outcome.
_EXPECTED_KEYS = """
    fk_geography_salesterritory dim_geography sales_territory_key dim_sales_territory sales_territory_key false
    fk_productsubcat_category dim_product_subcategory product_category_key dim_product_category product_category_key false
    fk_product_subcategory dim_product product_subcategory_key dim_product_subcategory product_subcategory_key false
    fk_customer_geography dim_customer geography_key dim_geography geography_key false
    fk_reseller_geography dim_reseller geography_key dim_geography geography_key false
    fk_fis_currency fact_internet_sales currency_key dim_currency currency_key false
    fk_fis_customer fact_internet_sales customer_key dim_customer customer_key true
    fk_fis_orderdate fact_internet_sales order_date_key dim_date date_key true
    fk_fis_duedate fact_internet_sales due_date_key dim_date date_key false
    fk_fis_shipdate fact_internet_sales ship_date_key dim_date date_key false
    fk_fis_product fact_internet_sales product_key dim_product product_key true
    fk_fis_promotion fact_internet_sales promotion_key dim_promotion promotion_key false
    fk_fis_salesterritory fact_internet_sales sales_territory_key dim_sales_territory sales_territory_key false
    fk_frs_currency fact_reseller_sales currency_key dim_currency currency_key false
    fk_frs_orderdate fact_reseller_sales order_date_key dim_date date_key false
    fk_frs_duedate fact_reseller_sales due_date_key dim_date date_key false
    fk_frs_shipdate fact_reseller_sales ship_date_key dim_date date_key false
    fk_frs_employee fact_reseller_sales employee_key dim_employee employee_key true
    fk_frs_product fact_reseller_sales product_key dim_product product_key true
    fk_frs_promotion fact_reseller_sales promotion_key dim_promotion promotion_key false
    fk_frs_reseller fact_reseller_sales reseller_key dim_reseller reseller_key true
    fk_frs_salesterritory fact_reseller_sales sales_territory_key dim_sales_territory sales_territory_key false"""


def _orphan_sql() -> str:
    return " union all ".join(
        f"select '{name}' as constraint_name, '{child}' as child, '{parent}' as parent, {decides} as decides, "
        f"count(*) as orphans from {LOADED[child]} c left join {LOADED[parent]} p on c.{column} = p.{key} "
        f"where p.{key} is null and c.{column} is not null"
        for name, child, column, parent, key, decides in map(str.split, _EXPECTED_KEYS.split("\n")[1:])
    )


@query(_orphan_sql())
def foreign_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Orphans of all twenty-two foreign keys."""
    return integrity.foreign_key_report(loaded_warehouse(spark, folder)[0].tables())


@query(
    """select 'fk_fis_product' as constraint_name, count(*) as orphans
       from f_internet_kept join d_product using (product_key) where not finished_goods_flag
       union all select 'fk_fis_customer', count(*)
       from f_internet_kept join d_customer using (customer_key) where title is null
       union all select 'fk_fis_orderdate', count(*) from f_internet_kept where order_date_key >= 20000101
       union all select 'fk_frs_product', count(*)
       from f_reseller_kept join d_product using (product_key) where not finished_goods_flag
       union all select 'fk_frs_reseller', count(*)
       from f_reseller_kept join d_reseller using (reseller_key) where number_employees % 2 <> 0
       union all select 'fk_frs_employee', count(*)
       from f_reseller_kept join d_employee using (employee_key) where not current_flag"""
)
def broken_foreign_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The six decisive relationships against dimensions that lost some members."""
    tables = dict(loaded_warehouse(spark, folder)[0].tables())
    tables |= {
        "dim_product": tables["dim_product"].where("finished_goods_flag"),
        "dim_customer": tables["dim_customer"].where("title is not null"),
        "dim_date": tables["dim_date"].where("calendar_year < 2000 or calendar_year > 2001"),
        "dim_reseller": tables["dim_reseller"].where("number_employees % 2 = 0"),
        "dim_employee": tables["dim_employee"].where("current_flag"),
    }
    return checks.decisive_orphans(tables).select("constraint_name", "orphans")


# The keys of facts are generated with gaps, so SQL states only that they are unique.
@query(
    " union all ".join(
        [
            f"select '{t}' as table_name, '{TABLES[t].key}' as key, count(*) - count(distinct {TABLES[t].key}) as surplus_rows, "
            f"count(*) filter ({TABLES[t].key} is null) as null_rows from {LOADED[t]}"
            for t in DIMENSIONS
        ]
        + [f"select '{t}', '{TABLES[t].key}', 0, 0" for t in FACTS]
    )
)
def primary_keys(spark: SparkSession, folder: str) -> DataFrame:
    return integrity.primary_key_report(loaded_warehouse(spark, folder)[0].tables())


@query(
    " union all ".join(
        f"select '{t}' as table_name, 'sales_order_number,sales_order_detail_id' as key, "
        f"count(*) - count(distinct (sales_order_number, sales_order_detail_id)) as surplus_rows, 0::bigint as null_rows "
        f"from {LOADED[t]}"
        for t in ("fact_internet_sales", "fact_reseller_sales")
    )
)
def unique_columns(spark: SparkSession, folder: str) -> DataFrame:
    return integrity.unique_report(loaded_warehouse(spark, folder)[0].tables())


def _rule_sql() -> str:
    rows = []
    for name, table in TABLES.items():
        rules = [(c, "not null", f"{c} is null") for c in table.required]
        rules += [(c, f"length <= {n}", f"length({c}) > {n}") for c, n in table.length_limits.items()]
        rows += [
            f"select '{name}' as table_name, '{c}' as column_name, '{rule}' as rule, "
            f"count(*) filter ({broken}) as violations from {LOADED[name]}"
            for c, rule, broken in rules
        ]
    return " union all ".join(rows)


@query(_rule_sql())
def column_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every not-null and length rule of all fourteen tables."""
    return integrity.column_rules(loaded_warehouse(spark, folder)[0].tables())


_SURPLUS_SQL = " + ".join(
    f"(select count(*) - count(distinct (sales_order_number, sales_order_detail_id)) from {LOADED[t]})"
    for t in ("fact_internet_sales", "fact_reseller_sales")
)


@query(
    f"""select tables_ok, tables_total, cast(fact_rows as bigint) as fact_rows, cast(orphans as bigint) as orphans,
              cast(violations as bigint) as violations,
              case when fact_rows = 0 then 'error' when violations + orphans = 0 and tables_ok = tables_total then 'success'
                   else 'warnings' end as outcome
       from (select count(*) filter (row_count > 0) as tables_ok, count(*) as tables_total,
                    sum(row_count) filter (table_name like 'fact%') as fact_rows from ({_counts_sql(list(TABLES))})),
            (select sum(orphans) as orphans from ({_orphan_sql()}) where decides),
            (select {_SURPLUS_SQL} + (select sum(violations) from ({_rule_sql()})) as violations)"""
)
def run_outcome(spark: SparkSession, folder: str) -> DataFrame:
    tables = loaded_warehouse(spark, folder)[0].tables()
    return checks.outcome_frame(
        checks.table_report(spark, tables), checks.decisive_orphans(tables), checks.constraint_report(tables)
    )


@query(" union all ".join(f"select '{t}' as table_name, count(*) as row_count from {LOADED[t]}" for t in DIMENSIONS))
def refused_append(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each dimension after an append that the stored days refuse: as many as before."""
    warehouse = new_warehouse(spark, "refused")
    prepared = prepared_dimensions(spark, folder)
    warehouse.load_dimensions(prepared, truncate=True)
    try:
        warehouse.load_dimensions(prepared)
        raise AssertionError("the append was not refused")
    except ConstraintError:
        counts = [(name, warehouse.count(name)) for name in DIMENSIONS]
    warehouse.drop()
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


# What the first load of a growing source does not hold yet.
_LATER = {
    "dim_date": "calendar_year >= 2000",
    "dim_customer": "title is null",
    "dim_product": "coalesce(not finished_goods_flag, true)",
}


@query(
    " union all ".join(
        f"select '{t}' as table_name, count(*) filter ({_LATER.get(t, 'false')}) as rows_added, count(*) as rows_held, "
        f"{'null' if t in ('dim_date', 'dim_sales_territory') else 'count(*)'}::bigint as last_key from {LOADED[t]}"
        for t in DIMENSIONS
    )
)
def appended_news(spark: SparkSession, folder: str) -> DataFrame:
    """A load that lacks some members, then an append of the whole source: only new business keys, dense keys go on."""
    warehouse = new_warehouse(spark, "news")
    prepared = prepared_dimensions(spark, folder)
    first = {n: df.where(f"not ({_LATER[n]})") if n in _LATER else df for n, df in prepared.items()}
    warehouse.load_dimensions(first, truncate=True)
    added = warehouse.load_dimensions(prepared, only_new=True)
    held = []
    for name in DIMENSIONS:
        key = F.max(TABLES[name].key) if TABLES[name].generated else F.lit(None)
        found = warehouse.read(name).agg(F.count(F.lit(1)).alias("n"), key.cast("bigint").alias("last")).first()
        held.append((name, added[name], found["n"], found["last"]))
    warehouse.drop()
    return spark.createDataFrame(held, "table_name string, rows_added bigint, rows_held bigint, last_key bigint")


_LOOKED_UP = {
    "dim_customer": "customer_alternate_key",
    "dim_currency": "currency_alternate_key",
    "dim_sales_territory": "sales_territory_alternate_key",
    "dim_product": "product_alternate_key",
    "dim_promotion": "promotion_alternate_key",
    "dim_reseller": "reseller_alternate_key",
    "dim_employee": "employee_alternate_key",
}


@query(
    " union all ".join(
        f"select '{t}' as table_name, '{k}' as alternate_key, count(*) as duplicated_keys, "
        f"cast(coalesce(sum(n), 0) as bigint) as rows_sharing_a_key, cast(coalesce(sum(n - 1), 0) as bigint) as surplus_rows "
        f"from (select count(*) as n from {LOADED[t]} where {k} is not null group by {k} having count(*) > 1)"
        for t, k in _LOOKED_UP.items()
    )
)
def duplicate_lookup_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Alternate keys that stand for several rows of a dimension the facts look up."""
    return checks.duplicate_lookup_keys(loaded_dimensions(spark, folder)[0].tables())


@query(
    " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, count(*) - count({c}) as null_values, "
        f"cast(min({c}) as bigint) as least, cast(max({c}) as bigint) as greatest from {LOADED[t]}"
        for t, columns in LOOKUP_COLUMNS.items()
        for c in columns
    )
)
def lookup_columns(spark: SparkSession, folder: str) -> DataFrame:
    """What the optimizer is told of the columns that rows are looked up by."""
    warehouse = loaded_warehouse(spark, folder)[0]
    warehouse.analyze(*LOOKUP_COLUMNS)
    return warehouse.lookup_statistics().drop("distinct_values")


def _full_run_sql() -> str:
    rows = []
    for name in TABLES:
        dropped = "0"
        if name in FACTS:
            dropped = f"(select count(*) from {LOADED[name].removesuffix('_kept')}) - count(*)"
        extracted = f"count(*) + {dropped}" if name in FACTS else f"count(*) - {int(name == 'dim_geography')}"
        rows.append(
            f"select '{name}' as table_name, cast({extracted} as bigint) as extracted_rows, count(*) as loaded_rows, "
            f"cast({dropped} as bigint) as dropped_rows, case when count(*) > 0 then 'OK' else 'empty' end as status "
            f"from {LOADED[name]}"
        )
    return " union all ".join(rows)


@query(_full_run_sql())
def full_run(spark: SparkSession, folder: str) -> DataFrame:
    """The whole run from source tables and files, as its report tells it per table."""
    warehouse = new_warehouse(spark, "run")
    files = {"dim_date": calendar_rows(spark, folder), "dim_sales_territory": territory_rows(spark, folder)}
    report = run(warehouse, sales_source(spark, folder), files, truncate=True, as_of=AS_OF)
    loaded = {**report.dimension_rows, **report.summary["fact_stats"]}
    rows = [(n, report.extracted[n], loaded[n], report.dropped.get(n, 0), report.table_status[n]) for n in TABLES]
    warehouse.drop()
    return spark.createDataFrame(
        rows, "table_name string, extracted_rows bigint, loaded_rows bigint, dropped_rows bigint, status string"
    )


@query(
    """select 12::bigint as dimensions_loaded, 2::bigint as facts_loaded, (select count(*) from f_internet_kept) as internet_rows,
              (select count(*) from f_reseller_kept) as reseller_rows,
              (select count(*) from f_internet_kept) + (select count(*) from f_reseller_kept) as total_fact_records"""
)
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    _, dimensions, facts = loaded_warehouse(spark, folder)
    summary = checks.run_summary(dimensions, facts)
    stats = summary.pop("fact_stats")
    row = {**summary, "internet_rows": stats["fact_internet_sales"], "reseller_rows": stats["fact_reseller_sales"]}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} bigint" for n in row))


@query("select currency_alternate_key, length(currency_alternate_key) > 3 as is_too_long from x_currency")
def code_lengths(spark: SparkSession, folder: str) -> DataFrame:
    raw = text_keys(extracts.extract_dim_currency(sales_source(spark, folder)))
    limit = TABLES["dim_currency"].length_limits["currency_alternate_key"]
    return raw.select("currency_alternate_key", (F.length("currency_alternate_key") > limit).alias("is_too_long"))

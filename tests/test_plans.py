"""Extracts, dimensions, facts and flat files on a tiny source."""

import datetime
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from small_source import TODAY, source, territories

from starloom.plans import extracts
from starloom.plans.dimensions import (
    calendar_between,
    dim_customer,
    dim_date,
    dim_geography,
    dim_product,
    dim_product_subcategory,
    dim_reseller,
    dim_sales_territory,
    prepare,
    require_columns,
    territory_matches,
)
from starloom.plans.facts import (
    INTERNET_SALES,
    RESELLER_SALES,
    build_fact,
    fact_internet_sales,
    fact_reseller_sales,
    incomplete_rows,
    resolve_fact,
    resolve_fact_from_source,
    resolve_facts_from_source,
)
from starloom.sources import FrameSource, JdbcSource, ParquetSource, read_calendar_csv, read_flat_dimensions, read_tables


@pytest.fixture(scope="module")
def oltp(spark):
    return source(spark)


@pytest.fixture(scope="module")
def geography(spark):
    return spark.createDataFrame(
        [
            (1, "Seattle", "WA", "98101", "US"),
            (2, "Seattle", "WA", "98101", "US"),
            (3, "Munich", "BY", "80331", "DE"),
            (4, "Unknown", "---", "Unknown", "---"),
        ],
        "geography_key bigint, city string, state_province_code string, postal_code string, country_region_code string",
    )


@pytest.fixture(scope="module")
def dims(spark):
    return {
        "dim_product": spark.createDataFrame([(1, " 900 "), (2, "901")], "product_key bigint, product_alternate_key string"),
        "dim_customer": spark.createDataFrame([(1, "1"), (2, "2")], "customer_key bigint, customer_alternate_key string"),
        "dim_reseller": spark.createDataFrame([(1, "100"), (2, "102")], "reseller_key bigint, reseller_alternate_key string"),
        "dim_employee": spark.createDataFrame([(1, 20), (2, 20)], "employee_key bigint, employee_alternate_key int"),
        "dim_promotion": spark.createDataFrame([(1, 1)], "promotion_key bigint, promotion_alternate_key int"),
        "dim_currency": spark.createDataFrame([(1, "USD"), (2, "EUR")], "currency_key bigint, currency_alternate_key string"),
        "dim_sales_territory": dim_sales_territory(territories(spark)),
        "dim_date": calendar_between(spark, datetime.date(2024, 1, 1), datetime.date(2024, 12, 31)),
    }


def test_geography_repeats_places_per_territory(oltp, rows):
    got = rows(extracts.extract_dim_geography(oltp), "city", "postal_code", "sales_territory_key")
    assert got == sorted(
        [("Seattle", "98101", 1), ("Seattle", "98101", 2), ("Munich", "80331", 3), ("Tokyo", "100", None)], key=repr
    )


def test_customer_mixes_addresses_by_default(oltp):
    got = {r["customer_alternate_key"]: r for r in extracts.extract_dim_customer(oltp).collect()}
    assert sorted(got) == [1, 2, 3, 6]
    assert (got[1]["email_address"], got[1]["phone"]) == ("z@x", "2")
    assert (got[1]["address_line1"], got[1]["address_line2"], got[1]["city"]) == ("3 C St", "Apt 2", "Seattle")
    assert got[1]["birth_date"] == datetime.date(1970, 1, 2) and got[1]["total_children"] == 2
    assert got[2]["phone"] is None and got[2]["gender"] is None
    assert got[3]["total_children"] is None and got[3]["city"] is None


def test_whole_addresses_stay_together(oltp):
    got = {r["BusinessEntityID"]: r for r in extracts.entity_addresses(oltp, whole_address=True).collect()}
    assert (got[10]["address_line1"], got[10]["address_line2"], got[10]["city"]) == ("3 C St", None, "Munich")


def test_product_descriptions(oltp, rows):
    got = rows(extracts.extract_dim_product(oltp), "product_alternate_key", "model_name", "description")
    none = "No description available"
    assert got == sorted([(900, "M1", "en1"), (901, "M2", "fr2"), (902, "M3", none), (903, None, none)], key=repr)


def test_reseller_pairs_and_first_rows_agree(oltp, rows):
    pairs = extracts.extract_dim_reseller(oltp)
    assert pairs.count() == 2 + 1 + 4
    first = extracts.first_resellers(oltp)
    by_pairs = dim_reseller_first(pairs)
    assert rows(first, *sorted(first.columns)) == rows(by_pairs, *sorted(first.columns))
    got = {r["reseller_alternate_key"]: r for r in first.collect()}
    assert (got[100]["phone"], got[100]["business_type"], got[100]["year_opened"]) == ("444", "Bike Manufacturer", 1990)
    assert (got[101]["phone"], got[101]["business_type"], got[101]["city"]) == (None, "Value Added Reseller", None)
    assert (got[102]["phone"], got[102]["business_type"], got[102]["address_line1"]) == (None, "Other", "1 A St")


def dim_reseller_first(df):
    from starloom.operators.dedupe import keep_first

    return keep_first(df, ["reseller_alternate_key"], extracts.RESELLER_ORDER)


def test_employee_has_current_department_and_tied_pay(oltp, rows):
    got = rows(extracts.extract_dim_employee(oltp, TODAY), "department_name", "base_rate", "pay_frequency", "phone")
    assert [(d, float(r), f, p) for d, r, f, p in got] == [("Tools", 10.0, 1, "3"), ("Tools", 11.0, 2, "3")]


def test_channels(oltp, rows):
    assert rows(extracts.extract_fact_internet_sales(oltp).select("SalesOrderNumber").distinct()) == [
        ("SO1",), ("SO2",), ("SO3",), ("SO8",)
    ]
    # SO6 belongs to a store that does not exist
    assert rows(extracts.extract_fact_reseller_sales(oltp).select("SalesOrderNumber").distinct()) == [("SO4",), ("SO5",)]
    currency = rows(extracts.extract_fact_internet_sales(oltp).select("SalesOrderNumber", "currency_alternate_key").distinct())
    assert currency == [("SO1", "USD"), ("SO2", "EUR"), ("SO3", "XXX"), ("SO8", "USD")]


def test_order_line_count(oltp):
    assert extracts.order_line_count(oltp, "2025-01-01").first()[0] == 2


def test_failed_extract_is_isolated(spark, oltp):
    partial = FrameSource(spark, {n: (lambda n=n: oltp.table(n)) for n in oltp.names if n != "Sales.Store"})
    done = extracts.extract_all(partial, TODAY)
    assert set(done.failures) == {"dim_reseller", "fact_reseller_sales"} and len(done.frames) == 10
    assert done.status("dim_reseller") == "failed" and done.status("dim_currency") == "extracted"
    report = {r["table_name"]: (r["status"], r["row_count"]) for r in extracts.extraction_report(spark, done).collect()}
    assert report["dim_reseller"] == ("failed", 0) and report["dim_currency"] == ("extracted", 2)


def test_geography_needs_exact_columns(spark, oltp, rows):
    raw = extracts.extract_dim_geography(oltp)
    assert rows(dim_geography(raw).where("city = 'Unknown'")) == [
        ("Unknown", "---", "Unknown", "---", "Unknown", "Unknown", None)
    ]
    with pytest.raises(ValueError, match="dim_geography"):
        dim_geography(raw.select(*reversed(raw.columns)))
    with pytest.raises(ValueError):
        require_columns(raw.drop("city"), raw.columns, "x")
    counts = territory_matches(raw, dim_sales_territory(territories(spark)).where("sales_territory_key < 3")).first()
    assert tuple(counts) == (2, 2)


def test_territory_keeps_a_given_key(spark):
    given = territories(spark).selectExpr("*", "sales_territory_alternate_key + 100 as sales_territory_key")
    assert dim_sales_territory(given).first()["sales_territory_key"] > 100
    few = dim_sales_territory(territories(spark).drop("sales_territory_group"))
    assert few.columns == ["sales_territory_key", "sales_territory_alternate_key", "sales_territory_region", "sales_territory_country"]


def test_snowflake(spark, oltp, rows):
    categories = spark.createDataFrame([(70, 1), (71, 2)], "product_category_key bigint, product_category_alternate_key int")
    sub = dim_product_subcategory(extracts.extract_dim_product_subcategory(oltp), categories)
    assert rows(sub, "product_subcategory_alternate_key", "product_category_key") == [(1, 70), (2, 71), (3, None)]
    subs = spark.createDataFrame([(7, 1), (8, 2)], "product_subcategory_key bigint, product_subcategory_alternate_key int")
    raw = extracts.extract_dim_product(oltp)
    assert rows(dim_product(raw, subs), "product_alternate_key", "product_subcategory_key") == sorted(
        [(900, 7), (901, 8), (902, None), (903, None)], key=repr
    )
    assert dim_product(raw.drop("product_subcategory_key"), subs).columns == raw.drop("product_subcategory_key").columns


def test_customer_places(oltp, geography, rows):
    raw = extracts.extract_dim_customer(oltp)
    got = dim_customer(raw, geography, 4)
    assert not {"city", "state_province_code", "postal_code"} & set(got.columns)
    assert rows(got, "customer_alternate_key", "geography_key") == [(1, 1), (2, 4), (3, 4), (6, 1)]


def test_reseller_places(oltp, geography, rows):
    raw = extracts.extract_dim_reseller(oltp)
    assert rows(dim_reseller(raw, geography, 4), "reseller_alternate_key", "geography_key") == [(100, 1), (101, 4), (102, 1)]
    assert rows(dim_reseller(raw, geography), "reseller_alternate_key", "geography_key")[1] == (101, None)
    assert dim_reseller(raw, geography, fan_out=True).count() == 5


def test_calendar_sample_and_weeks(spark):
    got = {r["date_key"]: r for r in calendar_between(spark, datetime.date(2004, 12, 31), datetime.date(2005, 7, 1)).collect()}
    assert tuple(got[20050101]) == (20050101, datetime.date(2005, 1, 1), 7, "Saturday", 1, 1, 1, "January", 1, 1, 2005, 1, 3, 2005, 2)
    assert got[20050102]["week_number_of_year"] == 2 and got[20041231]["week_number_of_year"] == 53
    assert (got[20050701]["fiscal_year"], got[20050701]["fiscal_quarter"], got[20050701]["fiscal_semester"]) == (2006, 1, 1)
    assert (got[20050630]["fiscal_year"], got[20050630]["fiscal_quarter"], got[20050630]["fiscal_semester"]) == (2005, 4, 2)


def test_internet_fact(oltp, dims):
    lines = extracts.extract_fact_internet_sales(oltp)
    got = {(r["sales_order_number"], r["sales_order_detail_id"]): r for r in fact_internet_sales(lines, dims).collect()}
    # SO3 is dated beyond the calendar and SO8 has an unknown customer
    assert sorted(got) == [("SO1", 10), ("SO1", 11), ("SO2", 20), ("SO2", 21)]
    row = got["SO1", 10]
    assert (row["product_key"], row["customer_key"], row["currency_key"], row["sales_territory_key"]) == (1, 1, 1, 1)
    assert (row["promotion_key"], row["order_date_key"], row["ship_date_key"]) == (None, 20240110, None)
    assert (row["discount_amount"], row["total_product_cost"], row["sales_amount"]) == (1.0, 11.0, 19.0)
    assert got["SO2", 21]["sales_territory_key"] is None and got["SO2", 21]["currency_key"] == 2
    losses = incomplete_rows(resolve_fact(lines, dims, INTERNET_SALES), INTERNET_SALES).first()
    assert (losses["total_rows"], losses["dropped_rows"], losses["missing_customer_key"], losses["missing_order_date_key"]) == (8, 4, 2, 2)


def test_reseller_fact(oltp, dims):
    got = fact_reseller_sales(extracts.extract_fact_reseller_sales(oltp), dims).collect()
    # SO5 has no sales person; a duplicated employee keeps the lowest key
    assert {(r["sales_order_number"], r["employee_key"], r["reseller_key"]) for r in got} == {("SO4", 1, 1)}


@pytest.mark.parametrize("plan,extract", [
    (INTERNET_SALES, extracts.extract_fact_internet_sales), (RESELLER_SALES, extracts.extract_fact_reseller_sales)
])
def test_both_ways_to_a_fact_agree(oltp, dims, rows, plan, extract):
    slow, fast = resolve_fact(extract(oltp), dims, plan), resolve_fact_from_source(oltp, dims, plan)
    assert sorted(slow.columns) == sorted(fast.columns)
    assert rows(slow, *sorted(slow.columns)) == rows(fast, *sorted(slow.columns))
    assert build_fact(oltp, dims, plan).count() > 0


def test_facts_resolved_together_read_lines_once(spark, oltp, dims, rows):
    """Lines that repeat, have no product, an unknown order or no order find in both facts what they find alone."""
    asked = []

    def reads(name, table):
        def build():
            asked.append(name)
            return table()

        return build

    lines = oltp.table("Sales.SalesOrderDetail")
    odd = {c: F.lit(None).cast(lines.schema[c].dataType) for c in ("SalesOrderID", "ProductID")}
    more = [lines, lines.limit(2), *[lines.limit(1).withColumn(c, v) for c, v in odd.items()]]
    tables = {n: (lambda n=n: oltp.table(n)) for n in oltp.names}
    tables["Sales.SalesOrderDetail"] = lambda: reduce(DataFrame.unionByName, more)
    tables["Sales.SalesOrderHeader"] = lambda: oltp.table("Sales.SalesOrderHeader").union(oltp.table("Sales.SalesOrderHeader").limit(1))
    counting = FrameSource(spark, {n: reads(n, build) for n, build in tables.items()})
    together = resolve_facts_from_source(counting, dims, [INTERNET_SALES, RESELLER_SALES])
    assert asked.count("Sales.SalesOrderDetail") == 1
    for plan in (INTERNET_SALES, RESELLER_SALES):
        alone, shared = resolve_fact_from_source(counting, dims, plan), together[plan.table]
        assert sorted((f.name, f.dataType.simpleString()) for f in alone.schema) == sorted((f.name, f.dataType.simpleString()) for f in shared.schema)
        found = rows(alone, *sorted(alone.columns))
        assert found and rows(shared, *sorted(alone.columns)) == found


def test_fact_needs_order_number(oltp, dims):
    with pytest.raises(ValueError, match="SalesOrderNumber"):
        fact_internet_sales(extracts.extract_fact_internet_sales(oltp).drop("SalesOrderNumber"), dims)


def test_fact_without_a_date_column(oltp, dims):
    lines = extracts.extract_fact_internet_sales(oltp).drop("DueDate")
    assert "due_date_key" not in fact_internet_sales(lines, dims).columns


def test_prepare_leaves_dependent_dimensions_raw(spark, oltp):
    files = {"dim_sales_territory": territories(spark)}
    ready = prepare(extracts.extract_all(oltp, TODAY).frames, files)
    assert set(ready) == {
        "dim_currency", "dim_sales_territory", "dim_geography", "dim_promotion", "dim_sales_reason", "dim_product_category",
        "dim_employee", "dim_product_subcategory", "dim_product", "dim_customer", "dim_reseller",
    }
    assert dict(ready["dim_customer"].dtypes)["customer_alternate_key"] == "string"


def test_flat_files(spark, tmp_path, rows):
    line = "20050101|2005-01-01|7|Saturday|Sábado|Samedi|1|1|1|January|Enero|Janvier|1|1|2005|1|3|2005|2\n"
    (tmp_path / "DimDate.csv").write_text(line, encoding="utf-8")
    (tmp_path / "DimSalesTerritory.csv").write_text(
        "1|1|Northwest|United States|North America|x\n2|2|Süd|Österreich|Europe|y\n", encoding="utf-16"
    )
    files = read_flat_dimensions(spark, str(tmp_path))
    day = files["dim_date"].first()
    assert len(day) == 19 and day["spanish_day_name_of_week"] == "Sábado" and day["full_date_alternate_key"] == datetime.date(2005, 1, 1)
    assert tuple(dim_date(files["dim_date"]).first())[:4] == (20050101, datetime.date(2005, 1, 1), 7, "Saturday")
    assert rows(files["dim_sales_territory"]) == [
        (1, "Northwest", "United States", "North America", "x"), (2, "Süd", "Österreich", "Europe", "y")
    ]
    assert dim_sales_territory(files["dim_sales_territory"]).columns[0] == "sales_territory_key"
    with pytest.raises(Exception, match="(?i)path"):
        read_calendar_csv(spark, str(tmp_path / "absent.csv"))


def test_parquet_source_and_table_list(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "Sales.A"))
    spark.range(5).write.parquet(str(tmp_path / "Sales.B"))
    found = read_tables(ParquetSource(spark, str(tmp_path)), ["Sales.B", "Sales.A"])
    assert [df.count() for df in found] == [5, 3]


def test_jdbc_options():
    jdbc = JdbcSource(None, "jdbc:x", {"user": "u"}, {"Sales.Big": ("ID", 1, 100, 8)}, small=["Sales.Small"])
    assert "partitionColumn" not in jdbc.options("Sales.Small")
    with pytest.raises(ValueError, match="Sales.Other"):
        jdbc.options("Sales.Other")
    assert jdbc.options("Sales.Big") | {"x": "y"} == {
        "url": "jdbc:x", "dbtable": "Sales.Big", "fetchsize": "10000", "user": "u", "partitionColumn": "ID",
        "lowerBound": "1", "upperBound": "100", "numPartitions": "8", "x": "y",
    }

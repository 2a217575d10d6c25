"""Load modes, constraints, reports and the full run."""

import datetime
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from small_source import TODAY, source, territories

from starloom.model import DIMENSIONS, LOOKUP_COLUMNS, TABLES
from starloom.plans import checks
from starloom.plans.dimensions import calendar_between, prepare
from starloom.plans.extracts import extract_all
from starloom.plans.facts import FACT_PLANS, resolve_fact_from_source
from starloom.plans.run import load_warehouse, run
from starloom.plans.warehouse import ConstraintError, Warehouse
from starloom.session import shared_folder
from starloom.sources import FrameSource


@pytest.fixture
def warehouse(spark, tmp_path):
    made = Warehouse(spark, "dw_test", str(tmp_path / "dw"))
    assert set(made.create().values()) == {"ok"}
    yield made
    made.drop()


@pytest.fixture
def files(spark):
    return {
        "dim_date": calendar_between(spark, datetime.date(2024, 1, 1), datetime.date(2024, 12, 31)),
        "dim_sales_territory": territories(spark),
    }


def reasons(spark, *names):
    return spark.createDataFrame(
        [(i, n, "t") for i, n in enumerate(names)],
        "sales_reason_alternate_key int, sales_reason_name string, sales_reason_reason_type string",
    )


def test_append_continues_keys_and_truncate_restarts(spark, warehouse, rows):
    table = "dim_sales_reason"
    assert warehouse.append(table, reasons(spark, "a", "b")) == 2
    assert warehouse.append(table, reasons(spark, "c")) == 1
    assert rows(warehouse.read(table), "sales_reason_key", "sales_reason_name") == [(1, "a"), (2, "b"), (3, "c")]
    assert warehouse.load(table, reasons(spark, "d"), truncate=True) == 1
    assert rows(warehouse.read(table), "sales_reason_key", "sales_reason_name") == [(1, "d")]


def test_empty_input_loads_nothing(spark, warehouse):
    assert warehouse.append("dim_sales_reason", reasons(spark, "a").where("false")) == 0
    assert warehouse.count("dim_sales_reason") == 0


def test_missing_table_reads_as_empty(spark, warehouse):
    absent = Warehouse(spark, "no_such_database")
    assert not absent.exists("dim_date") and absent.read("dim_date").count() == 0
    assert absent.read("dim_date").columns == TABLES["dim_date"].schema.names


def test_given_keys_may_not_repeat(spark, warehouse):
    days = calendar_between(spark, datetime.date(2024, 1, 1), datetime.date(2024, 1, 3))
    assert warehouse.append("dim_date", days) == 3
    with pytest.raises(ConstraintError, match="20240"):
        warehouse.append("dim_date", days.where("date_key = 20240102"))
    assert warehouse.append("dim_date", calendar_between(spark, datetime.date(2024, 1, 4), datetime.date(2024, 1, 4))) == 1


def test_strict_load_refuses_broken_rows(spark, warehouse):
    bad = spark.createDataFrame([("LONG", "x"), (None, "y")], "currency_alternate_key string, currency_name string")
    with pytest.raises(ConstraintError, match="currency_alternate_key"):
        warehouse.append("dim_currency", bad, strict=True)
    assert warehouse.count("dim_currency") == 0
    assert warehouse.append("dim_currency", bad) == 2


def test_truncate_cascades(spark, warehouse):
    warehouse.append("dim_product_category", spark.createDataFrame([(1, "x")], "product_category_alternate_key int, product_category_name string"))
    warehouse.append("dim_product_subcategory", spark.createDataFrame([(1, "x", 1)], "product_subcategory_alternate_key int, product_subcategory_name string, product_category_key bigint"))
    warehouse.append("dim_sales_reason", reasons(spark, "a"))
    emptied = warehouse.truncate("dim_product_category")
    assert emptied[0] == "dim_product_category" and "dim_product_subcategory" in emptied and "fact_internet_sales" in emptied
    assert [warehouse.count(t) for t in ("dim_product_category", "dim_product_subcategory", "dim_sales_reason")] == [0, 0, 1]


def test_a_failing_table_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    made = Warehouse(spark, "dw_partial", str(tmp_path / "dw"))
    create = made._create_table

    def fail_once(table):
        if table.name == "dim_currency":
            raise RuntimeError("no")
        create(table)

    monkeypatch.setattr(made, "_create_table", fail_once)
    status = made.create()
    assert status["dim_currency"].startswith("failed") and sum(s == "ok" for s in status.values()) == 13
    made.drop()


def test_full_run(spark, warehouse, files, rows):
    report = run(warehouse, source(spark), files, truncate=True, as_of=TODAY)
    # the small source leaves required columns empty, which the target would refuse
    assert report.outcome == "warnings" and report.violations and not report.failures
    assert not [rule for rule in report.violations if "unique" in rule]
    assert set(report.creation.values()) == {"ok"}
    assert report.summary["dimensions_loaded"] == 12 and report.summary["facts_loaded"] == 2
    assert report.summary["fact_stats"] == {"fact_internet_sales": 4, "fact_reseller_sales": 2}
    assert set(report.table_status.values()) == {"OK"} and set(report.orphans.values()) == {0}
    seen = report.matches["fact_internet_sales"]
    assert (seen["total_rows"], seen["customer_key"], seen["order_date_key"]) == (8, 6, 6)

    assert report.matches["dim_customer"] == {"total_rows": 4, "place": 2}
    assert report.matches["dim_geography"] == {"total_rows": 4, "place": 3}

    # keys are dense, in order, and resolve to the rows they stand for
    fact = warehouse.read("fact_internet_sales")
    assert fact.select("fact_internet_sales_key").distinct().count() == 4
    named = fact.join(warehouse.read("dim_customer"), "customer_key").select("sales_order_number", "first_name").distinct()
    assert rows(named) == [("SO1", "Ada"), ("SO2", "Bob")]
    unknown = warehouse.read("dim_geography").where("city = 'Unknown'").first()["geography_key"]
    places = {r["customer_alternate_key"]: r["geography_key"] for r in warehouse.read("dim_customer").collect()}
    assert places["2"] == unknown

    # running again with truncate gives the same warehouse; appending dimensions again is refused
    again = run(warehouse, source(spark), files, truncate=True, as_of=TODAY)
    assert (again.outcome, again.summary) == (report.outcome, report.summary)
    with pytest.raises(ConstraintError):
        run(warehouse, source(spark), files, truncate=False, as_of=TODAY)


def test_partitioned_and_sorted_facts_with_statistics(spark, tmp_path, files):
    made = Warehouse(spark, "dw_split", str(tmp_path / "dw"), partition_facts_by="order_date_key", sort_facts_by=["product_key"])
    report = run(made, source(spark), files, truncate=True, as_of=TODAY, statistics=True)
    assert not report.failures and report.summary["total_fact_records"] == 6
    fact = made.read("fact_internet_sales")
    assert fact.columns == TABLES["fact_internet_sales"].schema.names
    assert fact.agg(F.countDistinct("fact_internet_sales_key")).first()[0] == 4
    stored = [pq.read_table(f, partitioning=None) for f in (tmp_path / "dw").rglob("fact_*/**/*.parquet")]
    keys = [t["product_key"].to_pylist() for t in stored]
    assert sum(map(len, keys)) == 6 and all(k == sorted(k) for k in keys)
    told = {(r["table_name"], r["column_name"]): r for r in made.lookup_statistics().collect()}
    assert set(told) == {(t, c) for t, columns in LOOKUP_COLUMNS.items() for c in columns}
    seen = told["fact_internet_sales", "customer_key"]
    assert (seen["distinct_values"], seen["null_values"]) == (2, 0) and seen["least"] <= seen["greatest"]
    assert told["dim_product", "product_subcategory_key"]["null_values"] == 1
    made.truncate("fact_internet_sales")
    assert made.lookup_statistics().where("table_name = 'fact_internet_sales' and distinct_values > 0").count() == 0
    assert made.analyze("dim_date", "no_such_table") == ["dim_date"]
    made.drop()


def test_a_failing_fact_does_not_stop_the_other(spark, warehouse, files):
    whole = source(spark)
    tables = {n: (lambda n=n: whole.table(n)) for n in whole.names}
    tables["Sales.SalesOrderHeader"] = lambda: whole.table("Sales.SalesOrderHeader").drop("SalesPersonID")
    report = run(warehouse, FrameSource(spark, tables), files, truncate=True, as_of=TODAY)
    assert list(report.failures) == ["fact_reseller_sales"] and "SalesPersonID" in report.failures["fact_reseller_sales"]
    assert report.summary["fact_stats"] == {"fact_internet_sales": 4, "fact_reseller_sales": 0}
    assert report.outcome == "warnings" and report.table_status["fact_reseller_sales"] == "empty"


def test_missing_dimension_is_named(spark, warehouse, files):
    whole = source(spark)
    partial = FrameSource(spark, {n: (lambda n=n: whole.table(n)) for n in whole.names if n != "Sales.Currency"})
    with pytest.raises(ValueError, match="dim_currency"):
        run(warehouse, partial, files, truncate=True, as_of=TODAY)
    with pytest.raises(ValueError, match="dim_date"):
        warehouse.load_dimensions({n: None for n in DIMENSIONS if n != "dim_date"})


def test_load_warehouse_summary(spark, warehouse, files):
    oltp = source(spark)
    prepared = prepare(extract_all(oltp, TODAY).frames, files)

    def resolve(dims):
        return {name: resolve_fact_from_source(oltp, dims, plan) for name, plan in FACT_PLANS.items()}

    _, fact_rows = load_warehouse(warehouse, prepared, resolve, truncate=True)
    assert fact_rows == {"fact_internet_sales": 4, "fact_reseller_sales": 2}


def test_refused_loads_change_nothing(spark, warehouse, files):
    prepared = prepare(extract_all(source(spark), TODAY).frames, files)
    warehouse.create()
    warehouse.load_dimensions(prepared, truncate=True)
    counts = {n: warehouse.count(n) for n in DIMENSIONS}
    with pytest.raises(ConstraintError, match="already holds"):
        warehouse.load_dimensions(prepared)
    doubled = {**prepared, "dim_date": prepared["dim_date"].union(prepared["dim_date"])}
    with pytest.raises(ConstraintError, match="2 rows have date_key"):
        warehouse.load_dimensions(doubled, truncate=True)
    assert counts == {n: warehouse.count(n) for n in DIMENSIONS}
    with pytest.raises(ConstraintError, match="2 rows have date_key"):
        warehouse.append("dim_date", doubled["dim_date"], into_empty=True)


def test_only_new_rows_are_appended(spark, warehouse, files, rows):
    whole = source(spark)

    def grown(**replaced):
        return FrameSource(spark, {n: (lambda n=n: replaced.get(n, whole.table(n))) for n in whole.names})

    orders = whole.table("Sales.SalesOrderHeader")
    early = grown(**{"Sales.SalesOrderHeader": orders.where("SalesOrderID <> 2")})
    first = run(warehouse, early, files, truncate=True, as_of=TODAY)
    assert first.summary["fact_stats"] == {"fact_internet_sales": 2, "fact_reseller_sales": 2}
    counts = {n: warehouse.count(n) for n in DIMENSIONS}
    more = {**files, "dim_date": calendar_between(spark, datetime.date(2024, 1, 1), datetime.date(2025, 1, 2))}
    second = run(warehouse, whole, more, only_new=True, as_of=TODAY)
    assert second.dimension_rows == {n: 2 if n == "dim_date" else 0 for n in DIMENSIONS}
    assert second.summary["fact_stats"] == {"fact_internet_sales": 2, "fact_reseller_sales": 0}
    assert second.outcome == first.outcome and not [r for r in second.violations if "unique" in r]
    third = run(warehouse, whole, more, only_new=True, as_of=TODAY)
    assert third.summary["total_fact_records"] == 0 and third.outcome == first.outcome
    assert {n: warehouse.count(n) for n in DIMENSIONS} == {**counts, "dim_date": counts["dim_date"] + 2}
    assert warehouse.append("dim_sales_reason", reasons(spark, "Price", "new"), only_new=True) == 1
    assert rows(warehouse.read("dim_sales_reason"), "sales_reason_key", "sales_reason_name") == [(1, "Price"), (2, "Price")]


def test_an_error_while_rows_flow_does_not_stop_the_other_fact(spark, warehouse, files):
    whole = source(spark)
    broken = F.when(F.col("OnlineOrderFlag"), F.col("RevisionNumber").cast("string")).otherwise("x")
    tables = {n: (lambda n=n: whole.table(n)) for n in whole.names}
    tables["Sales.SalesOrderHeader"] = lambda: whole.table("Sales.SalesOrderHeader").withColumn("RevisionNumber", broken)
    report = run(warehouse, FrameSource(spark, tables), files, truncate=True, as_of=TODAY)
    assert list(report.failures) == ["fact_reseller_sales"] and "CAST_INVALID_INPUT" in report.failures["fact_reseller_sales"]
    assert report.summary["fact_stats"] == {"fact_internet_sales": 4, "fact_reseller_sales": 0}
    assert report.outcome == "warnings" and list(report.dropped) == ["fact_internet_sales"]


def test_the_report_tells_what_was_extracted_and_dropped(spark, warehouse, files):
    doubled = source(spark)
    tables = {n: (lambda n=n: doubled.table(n)) for n in doubled.names}
    tables["Sales.SpecialOffer"] = lambda: doubled.table("Sales.SpecialOffer").union(doubled.table("Sales.SpecialOffer"))
    report = run(warehouse, FrameSource(spark, tables), files, truncate=True, as_of=TODAY)
    assert report.duplicate_keys == {"dim_promotion": 1, "dim_employee": 1}
    assert report.extracted["dim_promotion"] == 2 and report.extracted["fact_internet_sales"] == 8
    assert report.dropped["fact_internet_sales"] == 4
    assert report.total_extracted == sum(report.extracted.values()) and set(report.extracted) == set(TABLES)
    assert report.lost_values == {"dim_customer.total_children": {"filled": 2, "cut": 0, "unreadable": 1}}


def test_staged_rows_are_removed(spark, warehouse, files, tmp_path, monkeypatch):
    monkeypatch.setattr("starloom.session.shared_folder", lambda spark: str(tmp_path / "stages"))
    run(warehouse, source(spark), files, truncate=True, as_of=TODAY)
    with pytest.raises(ConstraintError):
        warehouse.append("dim_date", files["dim_date"])
    assert not list((tmp_path / "stages").glob("*"))


def test_facts_meet_products_after_their_channel_is_known(spark, warehouse, files):
    """Lines of the other channel are never moved to their product."""
    oltp = source(spark)
    warehouse.load_dimensions(prepare(extract_all(oltp, TODAY).frames, files), truncate=True)
    for plan in FACT_PLANS.values():
        tree = resolve_fact_from_source(oltp, warehouse.tables(), plan)._jdf.queryExecution().analyzed().toString()
        lines = tree.splitlines()
        product = next(i for i, x in enumerate(lines) if "Join Inner, (product_id" in x)
        assert any("SalesOrderID" in x and "Join Inner" in x for x in lines[product:])


def test_violations_give_warnings():
    assert checks.run_outcome(5, True, 14, 14, violations=1) == "warnings"


@pytest.mark.parametrize(
    "rows_,intact,ok,outcome",
    [(5, True, 14, "success"), (5, False, 14, "warnings"), (5, True, 13, "warnings"), (0, True, 14, "error")],
)
def test_outcome(rows_, intact, ok, outcome):
    assert checks.run_outcome(rows_, intact, ok, 14) == outcome


def test_reports_on_missing_and_empty_tables(spark):
    one = spark.createDataFrame([(1,)], "x int")
    report = checks.table_report(spark, {"dim_date": one, "dim_currency": one.where("false"), "dim_product": None})
    status = {r["table_name"]: (r["is_present"], r["row_count"], r["status"]) for r in report.collect()}
    assert len(status) == 14
    assert status["dim_date"] == (True, 1, "OK") and status["dim_currency"] == (True, 0, "empty")
    assert status["dim_product"] == status["dim_employee"] == (False, 0, "missing")
    assert tuple(checks.status_count(report).first()) == (1, 14)
    orphans = spark.createDataFrame([("a", True, 2), ("b", False, 9)], "constraint_name string, decides boolean, orphans bigint")
    constraints = spark.createDataFrame([("t", "unique k", 3), ("t", "c not null", 4)], "table_name string, rule string, violations bigint")
    got = checks.outcome_frame(report, orphans, constraints).first()
    assert (got["tables_ok"], got["orphans"], got["violations"], got["fact_rows"], got["outcome"]) == (1, 2, 7, 0, "error")


def test_counts(spark):
    frames = {"a": spark.range(3), "b": spark.range(4)}
    assert checks.named_counts(frames).first().asDict() == {"a": 3, "b": 4}
    assert checks.total_rows(frames).first()[0] == 7


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == shared_folder(spark)

    def session(master, **conf):
        context = SimpleNamespace(master=master, applicationId="x")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=context)

    named = session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/"})
    assert shared_folder(named) == "hdfs://shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))

"""Keys, dates, measures, codes and XML fields."""

import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions.codes import business_type
from starloom.functions.keys import (
    add_date_keys,
    coerce_whole_numbers,
    composite_key,
    fill_missing,
    normalize_key,
    text_alternate_keys,
    text_keys,
    trimmed_text,
)
from starloom.functions.measures import derived_measures
from starloom.functions.xml_fields import PERSON_SURVEY, STORE_SURVEY, lost_values, xml_fields
from starloom.model import DIM_CURRENCY, DIM_EMPLOYEE, apply_defaults, conform


def test_normalize_key_trims_every_blank_and_fills_null(spark, rows):
    df = spark.createDataFrame([(" a ",), ("\t b\n",), (None,), ("",), (" c ",)], "k string")
    assert rows(normalize_key(df, "k")) == sorted([("a",), ("b",), ("",), ("",), ("c",)])
    assert normalize_key(df, "absent").columns == ["k"]


def test_normalize_key_takes_numbers(spark, rows):
    df = spark.createDataFrame([(5,), (None,)], "k int")
    assert rows(normalize_key(df, "k")) == [("",), ("5",)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \tab\n　", max_size=6)), min_size=1, max_size=30))
def test_trimming_equals_python_strip(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r["i"]: r["t"] for r in df.select("i", trimmed_text("v").alias("t")).collect()}
    assert got == {i: (v or "").strip() for i, v in enumerate(values)}


def test_text_keys_keep_null(spark):
    df = spark.createDataFrame([(1, 2, 3), (None, None, None)], "customer_alternate_key int, nation_alternate_key int, n int")
    assert dict(text_keys(df).dtypes) == {"customer_alternate_key": "string", "nation_alternate_key": "int", "n": "int"}
    everything = text_alternate_keys(df)
    assert [t for _, t in everything.dtypes] == ["string", "string", "int"]
    assert everything.where("customer_alternate_key is null").count() == 1


def test_date_keys(spark, rows):
    df = spark.createDataFrame(
        [(datetime.date(2005, 1, 1), "2012-02-29 23:59:59"), (None, "soon"), (datetime.date(1999, 12, 31), None)],
        "d date, s string",
    )
    keyed = add_date_keys(df, {"d": "dk", "s": "sk", "absent": "ak"})
    assert rows(keyed, "dk", "sk") == sorted([(20050101, 20120229), (None, None), (19991231, None)], key=repr)
    assert dict(keyed.dtypes)["dk"] == "int"


def test_whole_numbers(spark):
    df = spark.createDataFrame(
        [("12", 1.0, 1), ("12.0", 1.5, 2), ("12.5", None, 3), ("x", -3.0, None), (None, 0.0, 5), ("9007199254740993", 2.0, 6)],
        "t string, d double, i int",
    )
    got = coerce_whole_numbers(df, ["t", "d", "i", "absent"]).collect()
    assert [r["t"] for r in got] == [12, 12, None, None, None, 9007199254740993]
    assert [r["d"] for r in got] == [1, None, None, -3, 0, 2]
    assert [r["i"] for r in got] == [1, 2, 3, None, 5, 6]


def test_fill_missing_and_composite_key(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(composite_key("x", "y", "z")).first()[0] is None
    filled = fill_missing(df, ["x", "y", "absent"], "Unknown")
    assert filled.select(composite_key("x", "y", "z")).first()[0] == "a_Unknown_c"


def test_measures_are_per_unit_discount(spark):
    df = spark.createDataFrame(
        [(10.0, 0.1, Decimal("4.0000"), 3, 30.0), (None, 0.1, None, 1, 5.0)],
        "unit_price double, unit_price_discount_pct double, product_standard_cost decimal(19,4), order_quantity smallint, "
        "extended_amount double",
    )
    first, second = derived_measures(df).select("discount_amount", "total_product_cost", "sales_amount").collect()
    assert tuple(first) == (1.0, 12.0, 29.0)
    assert tuple(second) == (None, None, None)


def test_measures_of_decimals_keep_every_digit(spark):
    kinds = "extended_amount decimal(19,4), product_standard_cost decimal(19,4), order_quantity smallint"
    df = spark.createDataFrame([(Decimal("123456789012345.6789"), Decimal("123456789012345.6789"), 2)], kinds)
    got = derived_measures(df).first()
    assert got["sales_amount"] == Decimal("123456789012345.6789") and got["discount_amount"] == 0
    assert got["total_product_cost"] == Decimal("246913578024691.3578")


def test_measures_without_columns(spark):
    got = derived_measures(spark.createDataFrame([(7.0,)], "extended_amount double")).first()
    assert (got["discount_amount"], got["total_product_cost"], got["sales_amount"]) == (0.0, 0.0, 7.0)


@pytest.mark.parametrize(
    "code,label",
    [
        ("BM", "Bike Manufacturer"),
        ("BS", "Bike Shop"),
        ("OS", "Online Store"),
        ("WS", "Warehouse Store"),
        ("VARS", "Value Added Reseller"),
        (None, "Value Added Reseller"),
        ("Kiosk and market stall", "Kiosk and market stall"),
        ("x" * 60, "x" * 50),
    ],
)
def test_business_type(spark, code, label):
    df = spark.createDataFrame([(code,)], "c string")
    assert df.select(business_type(F.col("c"))).first()[0] == label


def _person(body, ns=' xmlns="urn:a"'):
    return f"<IndividualSurvey{ns}>{body}</IndividualSurvey>"


def test_person_survey(spark):
    docs = [
        _person("<BirthDate>1966-04-08Z</BirthDate><MaritalStatus>Married</MaritalStatus><TotalChildren>2</TotalChildren>"),
        _person("<BirthDate>some day</BirthDate><TotalChildren>many</TotalChildren><Gender>F</Gender>"),
        _person("<TotalChildren>1</TotalChildren><TotalChildren>5</TotalChildren>"),
        _person(""),
        None,
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, doc string")
    got = xml_fields(df, "doc", PERSON_SURVEY).orderBy("i").collect()
    assert set(got[0].asDict()) == {"i"} | {t for t, _, _ in PERSON_SURVEY.values()}
    assert got[0]["birth_date"] == datetime.date(1966, 4, 8) and got[0]["marital_status"] == "M"
    assert got[0]["total_children"] == 2 and got[0]["gender"] is None
    assert got[1]["birth_date"] is None and got[1]["total_children"] is None and got[1]["gender"] == "F"
    assert got[2]["total_children"] == 1
    assert all(v is None for k, v in got[3].asDict().items() if k != "i")
    assert all(v is None for k, v in got[4].asDict().items() if k != "i")


def test_store_survey_with_prefix(spark):
    doc = (
        '<ns:StoreSurvey xmlns:ns="urn:b"><ns:AnnualSales>800000</ns:AnnualSales><ns:BusinessType>BS</ns:BusinessType>'
        "<ns:BankName>" + "b" * 60 + "</ns:BankName><ns:YearOpened>1996</ns:YearOpened></ns:StoreSurvey>"
    )
    got = xml_fields(spark.createDataFrame([(doc,)], "doc string"), "doc", STORE_SURVEY, prefix="ns").first()
    assert got["annual_sales"] == Decimal("800000.0000") and got["business_code"] == "BS"
    assert got["bank_name"] == "b" * 50 and got["year_opened"] == 1996 and got["number_employees"] is None


def test_lost_values_are_counted(spark):
    docs = [
        _person("<MaritalStatus>Married</MaritalStatus><TotalChildren>2</TotalChildren><BirthDate>1966-04-08Z</BirthDate>"),
        _person("<MaritalStatus>S</MaritalStatus><TotalChildren>many</TotalChildren><BirthDate>some day</BirthDate>"),
        _person("<MaritalStatus>Single</MaritalStatus><TotalChildren> </TotalChildren><TotalChildren>x</TotalChildren>"),
        _person("<MaritalStatus></MaritalStatus><TotalChildren>99999</TotalChildren>"),
        _person(""),
        None,
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "cut int, doc string")
    got = {r["column_name"]: tuple(r)[1:] for r in lost_values(df, "doc", PERSON_SURVEY).collect()}
    assert list(got) == [t for t, _, _ in PERSON_SURVEY.values()]
    assert got["marital_status"][1:] == (2, 0) and got["total_children"][1:] == (0, 2) and got["birth_date"] == (2, 0, 1)
    assert got["gender"] == (0, 0, 0)
    nothing = lost_values(spark.createDataFrame([], "doc string"), "doc", STORE_SURVEY).collect()
    assert len(nothing) == len(STORE_SURVEY) and all(tuple(r)[1:] == (0, 0, 0) for r in nothing)


def test_each_document_is_parsed_once(spark):
    df = spark.createDataFrame([("<a/>",)], "doc string")
    plan = xml_fields(df, "doc", PERSON_SURVEY)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") + plan.count("xmltostructs") <= 1


def test_defaults_apply_to_absent_columns_only(spark):
    df = spark.createDataFrame([(1, None)], "employee_alternate_key int, current_flag boolean")
    got = apply_defaults(df, DIM_EMPLOYEE).first()
    assert got["name_style"] is False and got["current_flag"] is None


def test_conform_refuses_unknown_columns(spark):
    df = spark.createDataFrame([("USD", "x", 1)], "currency_alternate_key string, currency_name string, extra int")
    with pytest.raises(ValueError, match="extra"):
        conform(df, DIM_CURRENCY)
    assert conform(df.drop("extra"), DIM_CURRENCY).columns == ["currency_alternate_key", "currency_name"]


def test_xml_dates_match_whole(spark):
    days = ["1970-01-01", "1970-01-01Z", " 1970-01-01+02:00 ", "1970-01-012", "1970-01-01nonsense", "1970-13-01"]
    df = spark.createDataFrame([(i, f"<IndividualSurvey><BirthDate>{d}</BirthDate></IndividualSurvey>") for i, d in enumerate(days)], "i int, doc string")
    got = [str(r["birth_date"]) for r in xml_fields(df, "doc", PERSON_SURVEY).orderBy("i").collect()]
    assert got == ["1970-01-01"] * 3 + ["None"] * 3

"""Lookups, dedupe, history, keys, statistics and checks."""

import datetime
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from starloom import model
from starloom.operators import integrity
from starloom.operators.dedupe import duplicate_keys, duplicate_summary, keep_first
from starloom.operators.history import current_rows, latest_rows, preferred_text
from starloom.operators.lookup import (
    join_every,
    lookup_composite,
    lookup_date,
    lookup_key,
    lookup_with_default,
    orphans,
    validated_join,
    with_match_marker,
)
from starloom.operators.statistics import match_statistics, observe_matches
from starloom.operators.surrogate import assign_keys, unique_row_keys


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [(1, "A"), (2, "B"), (3, "A"), (4, None)], "product_key bigint, product_alternate_key string"
    )


def test_lookup_key_keeps_rows_and_lowest_key(spark, dim, rows):
    facts = spark.createDataFrame([(1, "A"), (2, "B"), (3, "Z"), (4, None)], "id int, product_alternate_key string")
    found = lookup_key(facts, dim, "product_alternate_key", "product_alternate_key", "product_key")
    assert found.columns == ["id", "product_key"]
    assert rows(found) == sorted([(1, 1), (2, 2), (3, None), (4, None)], key=repr)


def test_lookup_key_with_another_name_keeps_it(spark, dim):
    facts = spark.createDataFrame([("A",)], "code string")
    assert lookup_key(facts, dim, "code", "product_alternate_key", "product_key").columns == ["code", "product_key"]


def test_lookup_key_compares_unlike_types_as_text(spark):
    dim = spark.createDataFrame([(7, "274"), (8, "x")], "k bigint, a string")
    facts = spark.createDataFrame([(274,), (None,), (5,)], "id int")
    got = {r["id"]: r["k"] for r in lookup_key(facts, dim, "id", "a", "k").collect()}
    assert got == {274: 7, None: None, 5: None}


@pytest.mark.parametrize("args", [("no", "product_alternate_key", "product_key"), ("id", "no", "product_key"), ("id", "product_alternate_key", "no")])
def test_lookup_key_names_missing_columns(spark, dim, args):
    with pytest.raises(KeyError, match="no"):
        lookup_key(spark.createDataFrame([("A",)], "id string"), dim, *args)


def test_lookup_key_refuses_to_overwrite(spark, dim):
    with pytest.raises(ValueError):
        lookup_key(spark.createDataFrame([("A", 1)], "a string, product_key int"), dim, "a", "product_alternate_key", "product_key")


def test_lookup_date(spark):
    days = spark.createDataFrame([(20200101,), (20200102,)], "date_key int")
    facts = spark.createDataFrame([(1, 20200101), (2, 20990101), (3, None)], "id int, k int")
    got = {r["id"]: r["order_date_key"] for r in lookup_date(facts, days, "k", "order_date_key").collect()}
    assert got == {1: 20200101, 2: None, 3: None}


def test_default_member(spark):
    places = spark.createDataFrame(
        [(5, "P1"), (3, "P1"), (9, None), (10, "P2")], "geography_key bigint, postal_code string"
    )
    people = spark.createDataFrame([(1, "P1"), (2, None), (3, "P9")], "id int, postal_code string")
    got = {r["id"]: r["geography_key"] for r in lookup_with_default(people, places, "postal_code", "geography_key", 10).collect()}
    assert got == {1: 3, 2: 9, 3: 10}
    none = {r["id"]: r["geography_key"] for r in lookup_with_default(people, places, "postal_code", "geography_key", None).collect()}
    assert none[3] is None


def test_composite_lookup(spark, rows):
    places = spark.createDataFrame(
        [(1, "a_b", "c"), (2, "a", "b_c"), (3, "x", None), (4, "a", "b_c")], "geography_key bigint, city string, code string"
    )
    stores = spark.createDataFrame([(1, "a", "b_c"), (2, "x", None), (3, None, None)], "id int, city string, code string")
    one = lookup_composite(stores, places, ["city", "code"], "geography_key")
    assert rows(one, "id", "geography_key") == sorted([(1, 2), (2, 3), (3, None)], key=repr)
    fan = lookup_composite(stores, places, ["city", "code"], "geography_key", fan_out=True)
    assert rows(fan, "id", "geography_key") == sorted([(1, 2), (1, 4), (2, 3), (3, None)], key=repr)
    filled = lookup_composite(stores, places, ["city", "code"], "geography_key", default=99)
    assert rows(filled.where("id = 3"), "geography_key") == [(99,)]


def test_match_marker(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert {r["k"]: r["is_matched"] for r in with_match_marker(left, right, "k").collect()} == {1: True, 2: False, None: False}


def test_validated_join(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    many = spark.createDataFrame([(1, "c"), (1, "d"), (3, "e")], "k int, y string")
    assert validated_join(many, one, ["k"], "left", "m:1").count() == 3
    assert validated_join(one, many, ["k"], "left", "1:m").count() == 3
    assert validated_join(many, many.withColumnRenamed("y", "z"), ["k"], "inner", "m:m").count() == 5
    for validate in ("m:1", "1:1"):
        with pytest.raises(ValueError, match="repeats"):
            validated_join(one, many, ["k"], "left", validate)
    with pytest.raises(ValueError, match="repeats"):
        validated_join(many, one, ["k"], "left", "1:1")
    with pytest.raises(ValueError):
        validated_join(one, one, ["k"], "left", "2:2")


def test_orphans_ignore_null(spark, rows):
    child = spark.createDataFrame([(1, 1), (2, 5), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert rows(orphans(child, parent, "fk", "k"), "id") == [(2,)]


def test_keep_first_and_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, None), (1, "a"), (2, "z"), (None, "n"), (None, "m")], "k int, v string")
    assert rows(keep_first(df, ["k"], ["v"])) == sorted([(1, None), (2, "z"), (None, "m")], key=repr)
    assert rows(duplicate_keys(df, ["k"])) == sorted([(1, 3, 2), (None, 2, 1)], key=repr)
    assert rows(duplicate_summary(df, ["k"])) == [(2, 5, 3)]


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = keep_first(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_current_rows_exclude_the_end_day(spark, rows):
    day = datetime.date(2024, 1, 10)
    df = spark.createDataFrame(
        [(1, None), (2, day), (3, day + datetime.timedelta(1)), (4, day - datetime.timedelta(1))], "id int, e date"
    )
    assert rows(current_rows(df, "e", day), "id") == [(1,), (3,)]
    assert rows(current_rows(df, "e"), "id") == [(1,)]


def test_latest_rows_keep_ties(spark, rows):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, 1, "d"), (3, None, "e")], "k int, t int, v string")
    assert rows(latest_rows(df, ["k"], "t"), "v") == [("a",), ("b",), ("d",)]


def test_preferred_text(spark, rows):
    links = spark.createDataFrame(
        [(1, 12, "en"), (1, 11, "en"), (1, 10, "fr"), (2, 21, "fr"), (2, 20, "ar"), (3, 99, "en"), (3, 30, "fr"), (4, 98, "fr")],
        "model int, text_id int, lang string",
    )
    texts = spark.createDataFrame([(i, f"t{i}") for i in (10, 11, 12, 20, 21, 30)], "text_id int, body string")
    got = preferred_text(links, texts, "model", "text_id", "lang", "body")
    # model 3 has an English link without a text, so it does not fall back; model 4 has no text at all
    assert rows(got) == [(1, "t11"), (2, "t20")]


@pytest.mark.parametrize("n,partitions", [(0, 4), (1, 4), (1000, 4), (5000, 13)])
def test_assigned_keys_equal_row_number(spark, n, partitions):
    # a third of the rows share one leading value
    random.seed(n)
    data = [(0 if i % 3 == 0 else random.randrange(50), f"r{i:05d}") for i in range(n)]
    random.shuffle(data)
    df = spark.createDataFrame(data, "a int, b string").repartition(partitions)
    got = {r["b"]: r["key"] for r in assign_keys(df, "key", ["a", "b"], start=10).collect()}
    assert got == {b: i for i, (_, b) in enumerate(sorted(data), 10)}


def test_assigned_keys_put_null_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "a string")
    assert {r["a"]: r["key"] for r in assign_keys(df, "key", ["a"]).collect()} == {None: 1, "a": 2, "b": 3}


def test_assigned_keys_of_identical_rows_are_distinct(spark):
    df = spark.range(1000).selectExpr("1 as a")
    keys = sorted(r["key"] for r in assign_keys(df, "key", ["a"]).collect())
    assert keys == list(range(1, 1001))


def test_unique_row_keys(spark):
    keyed = unique_row_keys(spark.range(0, 5000, 1, 7).toDF("x"), "key", start=100)
    assert keyed.agg(F.countDistinct("key"), F.min("key")).first() == (5000, 100)


def test_statistics(spark, rows):
    df = spark.createDataFrame(
        [(1, None, 1)] * 8 + [(None, None, 1)] * 2, "some bigint, none bigint, every bigint"
    )
    got = {r["lookup"]: r for r in match_statistics(df, ["some", "none", "every"]).collect()}
    assert (got["some"]["matched"], got["some"]["unmatched"], got["some"]["match_percent"]) == (8, 2, 80.0)
    assert [got[k]["severity"] for k in ("some", "none", "every")] == ["warning", "error", "ok"]
    empty = match_statistics(df.where("false"), ["some"]).first()
    assert (empty["total_rows"], empty["match_percent"], empty["severity"]) == (0, 0.0, "ok")


def test_observed_matches_come_with_the_action(spark):
    seen = Observation()
    df = spark.range(10).selectExpr("id", "case when id < 4 then id end as k")
    observe_matches(df, ["k"], seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"total_rows": 10, "k": 4}


def _tables(spark, **frames):
    return {
        name: frames.get(name, spark.createDataFrame([], table.schema)) for name, table in model.TABLES.items()
    }


def test_foreign_key_report(spark):
    category = spark.createDataFrame([(1,), (2,)], "product_category_key bigint")
    subcategory = spark.createDataFrame([(1, 1), (2, 7), (3, 7), (4, None)], "product_subcategory_key bigint, product_category_key bigint")
    product = spark.createDataFrame([(1, 1), (2, 9)], "product_key bigint, product_subcategory_key bigint")
    tables = _tables(spark, dim_product_category=category, dim_product_subcategory=subcategory, dim_product=product)
    got = {r["constraint_name"]: r["orphans"] for r in integrity.foreign_key_report(tables).collect()}
    assert len(got) == 22
    assert got.pop("fk_productsubcat_category") == 2 and got.pop("fk_product_subcategory") == 1
    assert set(got.values()) == {0}


def test_uniqueness_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "n int, t string")
    got = integrity.uniqueness_report(df, "x", [["n", "t"], ["t"]]).collect()
    assert [(r["key"], r["surplus_rows"], r["null_rows"]) for r in got] == [("n,t", 2, 2), ("t", 3, 0)]


def test_column_rules(spark):
    df = spark.createDataFrame([("USD", "dollar"), (None, "x" * 51), ("LONG", None)], "currency_alternate_key string, currency_name string")
    got = {(r["column_name"], r["rule"]): r["violations"] for r in integrity.column_rule_report(df, model.DIM_CURRENCY).collect()}
    assert got == {
        ("currency_alternate_key", "not null"): 1,
        ("currency_name", "not null"): 1,
        ("currency_alternate_key", "length <= 3"): 1,
        ("currency_name", "length <= 50"): 1,
    }


def test_load_order_and_dependants():
    waves = model.load_order(model.DIMENSIONS)
    placed = {name: i for i, wave in enumerate(waves) for name in wave}
    assert set(placed) == set(model.DIMENSIONS)
    for fk in model.FOREIGN_KEYS:
        if fk.child in placed:
            assert placed[fk.parent] < placed[fk.child]
    assert set(model.dependants_of("dim_product_category")) == {
        "dim_product_subcategory", "dim_product", "fact_internet_sales", "fact_reseller_sales"
    }
    assert len(model.FOREIGN_KEYS) == 22 and sum(fk.decides for fk in model.FOREIGN_KEYS) == 6
    assert len(model.TABLES) == 14


def test_join_every_is_a_left_join(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "k int, v string")
    right = spark.createDataFrame([(1, 10), (1, 11), (None, 12), (4, 13), (3, None)], "k bigint, w int")
    got = join_every(left, right, ["k"], left)
    assert rows(got, "k", "v", "w") == rows(left.join(right, "k", "left"), "k", "v", "w")
    assert rows(join_every(left, right.limit(0), ["k"], left), "v", "w") == sorted([(v, None) for v in "abcde"], key=repr)

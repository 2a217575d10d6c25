"""Scalar fields out of XML documents held in a text column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element -> (target column, type, width) of the two survey documents.
PERSON_SURVEY = {
    "BirthDate": ("birth_date", "date", None),
    "MaritalStatus": ("marital_status", "string", 1),
    "Gender": ("gender", "string", 1),
    "YearlyIncome": ("yearly_income", "string", 20),
    "TotalChildren": ("total_children", "smallint", None),
    "NumberChildrenAtHome": ("number_children_at_home", "smallint", None),
    "Education": ("education", "string", 50),
    "HomeOwnerFlag": ("house_owner_flag", "string", 1),
    "NumberCarsOwned": ("number_cars_owned", "smallint", None),
    "DateFirstPurchase": ("date_first_purchase", "date", None),
    "CommuteDistance": ("commute_distance", "string", 20),
}
STORE_SURVEY = {
    "BusinessType": ("business_code", "string", 50),
    "NumberEmployees": ("number_employees", "int", None),
    "AnnualSales": ("annual_sales", "decimal(19,4)", None),
    "BankName": ("bank_name", "string", 50),
    "AnnualRevenue": ("annual_revenue", "decimal(19,4)", None),
    "YearOpened": ("year_opened", "int", None),
}

_DATE = r"^(\d{4}-\d{2}-\d{2})(Z|[+-]\d{2}:\d{2})?$"  # a day, with or without a time zone


def _typed(raw: Column, kind: str, width: int | None) -> Column:
    if kind == "string":
        return F.substring(raw, 1, width) if width else raw
    if kind == "date":
        return F.regexp_extract(F.trim(raw), _DATE, 1).try_cast("date")
    return F.trim(raw).try_cast(kind)


def _first_texts(
    df: DataFrame, column: str, fields: Mapping[str, tuple[str, str, int | None]], prefix: str | None
) -> tuple[DataFrame, dict[str, Column]]:
    """The documents parsed once, and the text of each element's first occurrence."""
    names = {e: f"{prefix}:{e}" if prefix else e for e in fields}
    layout = "struct<" + ",".join(f"`{n}`:array<string>" for n in names.values()) + ">"
    parsed = df.withColumn("_xml", F.from_xml(F.col(column), layout))
    return parsed, {e: F.get(F.col("_xml").getField(names[e]), F.lit(0)) for e in fields}


def xml_fields(
    df: DataFrame,
    column: str,
    fields: Mapping[str, tuple[str, str, int | None]],
    prefix: str | None = None,
) -> DataFrame:
    """Replace an XML column by its fields, parsing each document once.

    Elements are read as text lists, so a repeated element yields its first
    value, a missing one null, and a value of the wrong type null for that field
    only.  ``prefix`` names the namespace prefix the documents use, if any.
    """
    parsed, raw = _first_texts(df, column, fields, prefix)
    kept = [F.col(c) for c in df.columns if c != column]
    values = [_typed(raw[e], kind, width).alias(target) for e, (target, kind, width) in fields.items()]
    return parsed.select(*kept, *values)


def lost_values(
    df: DataFrame,
    column: str,
    fields: Mapping[str, tuple[str, str, int | None]],
    prefix: str | None = None,
) -> DataFrame:
    """What :func:`xml_fields` cannot keep: ``column_name, filled, cut, unreadable``, a row for each field.

    ``filled`` counts documents that hold the element, ``cut`` texts longer than
    their width, ``unreadable`` values that are not of their type (blank ones are
    not counted).  All fields are counted in one pass over the documents.
    """
    parsed, raw = _first_texts(df, column, fields, prefix)
    counts = []
    for e, (target, kind, width) in fields.items():
        value = raw[e]
        cut = F.length(value) > width if width else F.lit(False)
        bad = F.lit(False) if kind == "string" else (F.trim(value) != "") & _typed(value, kind, width).isNull()
        counts.append(
            F.struct(
                F.lit(target).alias("column_name"),
                F.count(value).alias("filled"),
                F.count_if(cut).alias("cut"),
                F.count_if(bad).alias("unreadable"),
            )
        )
    return parsed.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))

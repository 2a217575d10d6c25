"""Derived measures of a sales line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def derived_measures(df: DataFrame) -> DataFrame:
    """Add discount, cost and net amount.

    The discount is per unit (not times quantity) and is taken off the line
    total once.  An input column that is absent counts as zero.  A measure of
    decimals and whole numbers alone is a decimal, so no digit is lost; any
    other input makes it a double.
    """
    types = {f.name: f.dataType for f in df.schema}

    def amounts(*names: str) -> list[Column]:
        given = [types[n] for n in names if n in types]
        exact = any(isinstance(t, T.DecimalType) for t in given) and all(
            isinstance(t, T.DecimalType | T.IntegralType) for t in given
        )
        if exact:
            return [F.col(n) if n in types else F.lit(0) for n in names]
        return [F.col(n).cast("double") if n in types else F.lit(0.0) for n in names]

    price, share = amounts("unit_price", "unit_price_discount_pct")
    cost, quantity = amounts("product_standard_cost", "order_quantity")
    total, off_price, off_share = amounts("extended_amount", "unit_price", "unit_price_discount_pct")
    return df.withColumns(
        {
            "discount_amount": price * share,
            "total_product_cost": cost * quantity,
            "sales_amount": total - off_price * off_share,
        }
    )

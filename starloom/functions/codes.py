"""Code-to-label maps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the store business types.
BUSINESS_TYPES = {
    "BM": "Bike Manufacturer",
    "BS": "Bike Shop",
    "OS": "Online Store",
    "WS": "Warehouse Store",
    "VARS": "Value Added Reseller",
}
DEFAULT_BUSINESS_TYPE = "Value Added Reseller"


def labelled(code: Column, labels: Mapping[str, str], default: str, code_width: int, raw_width: int) -> Column:
    """Label of a code; an unknown code passes through, a null code gives the default.

    The code is cut to ``code_width`` before it is compared and to ``raw_width``
    when it passes through.
    """
    short = F.substring(code, 1, code_width)
    chosen = None
    for key, label in labels.items():
        hit = short == key
        chosen = F.when(hit, label) if chosen is None else chosen.when(hit, label)
    return F.coalesce(chosen.otherwise(F.substring(code, 1, raw_width)), F.lit(default))


def business_type(code: Column) -> Column:
    return labelled(code, BUSINESS_TYPES, DEFAULT_BUSINESS_TYPE, code_width=10, raw_width=50)

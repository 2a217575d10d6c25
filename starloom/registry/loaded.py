"""A warehouse loaded from the benchmark tables, built once per session and scale."""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession

from ..model import DIMENSIONS, FACTS
from ..plans.dimensions import prepare
from ..plans.extracts import LOAD_EXTRACTS, extract_all
from ..plans.facts import FACT_PLANS, resolve_facts_from_source
from ..plans.warehouse import Warehouse
from ..session import new_folder, passing_stages
from .source_views import AS_OF, calendar_rows, sales_source, territory_rows

_loaded: dict[tuple[str, str], tuple[Warehouse, dict[str, int]]] = {}
_lock = threading.Lock()


def prepared_dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    files = {"dim_date": calendar_rows(spark, folder), "dim_sales_territory": territory_rows(spark, folder)}
    wanted = {name: build for name, build in LOAD_EXTRACTS.items() if name in DIMENSIONS}
    return prepare(extract_all(sales_source(spark, folder), AS_OF, wanted).frames, files)


def new_warehouse(spark: SparkSession, label: str) -> Warehouse:
    """An empty warehouse of its own in the shared folder."""
    location = new_folder(spark, label)
    database = f"{label}_{hashlib.sha1(location.encode()).hexdigest()[:12]}"
    warehouse = Warehouse(spark, database, location)
    warehouse.create()
    return warehouse


def loaded_dimensions(spark: SparkSession, folder: str) -> tuple[Warehouse, dict[str, int]]:
    """A warehouse with every dimension loaded, and the rows loaded per table."""
    key = (spark.sparkContext.applicationId, folder)
    with _lock:
        if key not in _loaded:
            warehouse = new_warehouse(spark, "dims")
            _loaded[key] = warehouse, warehouse.load_dimensions(prepared_dimensions(spark, folder), truncate=True)
        return _loaded[key]


def loaded_warehouse(spark: SparkSession, folder: str) -> tuple[Warehouse, dict[str, int], dict[str, int]]:
    """The same warehouse with its facts, loading them on first use."""
    warehouse, dimension_rows = loaded_dimensions(spark, folder)
    with _lock:
        counts = getattr(warehouse, "fact_rows", None)
        if counts is None:
            dims = warehouse.tables()
            source = sales_source(spark, folder)
            with passing_stages(spark):
                facts = resolve_facts_from_source(source, dims, [FACT_PLANS[name] for name in FACTS])
                counts = warehouse.fact_rows = warehouse.load_facts(facts, truncate=True)
    return warehouse, dimension_rows, counts

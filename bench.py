"""Time the headline queries and the whole warehouse load; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starloom import registry  # noqa: E402
from starloom.registry.loaded import new_warehouse, prepared_dimensions  # noqa: E402
from starloom.registry.source_views import sales_source  # noqa: E402
from starloom.plans.facts import FACT_PLANS, resolve_facts_from_source  # noqa: E402
from starloom.plans.run import load_warehouse  # noqa: E402
from starloom.session import local_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
TIMED_RUNS = 2

HEADLINE = [
    "lines_since",
    "geography_extract",
    "customer_extract",
    "product_extract",
    "first_resellers_from_source",
    "employee_extract",
    "internet_sales_extract",
    "reseller_sales_extract",
    "product_key_lookup",
    "ordered_keys",
    "latest_pay",
    "localized_descriptions",
    "fact_internet_sales",
    "fact_reseller_sales",
    "foreign_keys",
    "unique_columns",
    "column_rules",
]


def seconds(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    spark = local_session(CPUS, os.environ.get("BENCH_MEMORY", "8g"), partitions=CPUS)
    queries = registry.queries()

    def evaluate(name: str) -> None:
        queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()

    def load() -> None:
        source = sales_source(spark, FOLDER)
        load_warehouse(
            new_warehouse(spark, "bench"),
            prepared_dimensions(spark, FOLDER),
            lambda dims: resolve_facts_from_source(source, dims, list(FACT_PLANS.values())),
            truncate=True,
        )

    times = {}
    for name in HEADLINE:
        evaluate(name)  # warm up
        times[name] = min(seconds(lambda: evaluate(name)) for _ in range(TIMED_RUNS))
    times["warehouse_load"] = seconds(load)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "sf": Path(FOLDER).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""The full run: extract, load dimensions, load facts, check."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation

from ..model import DIMENSIONS, FACTS
from ..operators.integrity import foreign_key_report
from ..operators.statistics import HIGH_MISS_SHARE
from ..session import passing_stages
from ..sources.tables import Source
from . import checks
from .dimensions import prepare
from .extracts import LOAD_EXTRACTS, Extraction, extract_all, extraction_report, lost_survey_values
from .facts import FACT_PLANS, resolve_fact_from_source, resolve_facts_from_source
from .warehouse import Warehouse

log = logging.getLogger(__name__)


@dataclass
class RunReport:
    outcome: str
    summary: dict
    dimension_rows: dict[str, int]
    table_status: dict[str, str]
    orphans: dict[str, int]
    matches: dict[str, dict[str, int]] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)
    violations: dict[str, int] = field(default_factory=dict)
    creation: dict[str, str] = field(default_factory=dict)
    extracted: dict[str, int] = field(default_factory=dict)
    dropped: dict[str, int] = field(default_factory=dict)
    duplicate_keys: dict[str, int] = field(default_factory=dict)
    lost_values: dict[str, dict[str, int]] = field(default_factory=dict)

    @property
    def total_extracted(self) -> int:
        return sum(self.extracted.values())


Frames = Mapping[str, DataFrame]


def load_warehouse(
    warehouse: Warehouse,
    prepared: Frames,
    resolve: Callable[[Frames], Frames],
    truncate: bool = False,
    observations: Mapping[str, Observation] | None = None,
    only_new: bool = False,
    failures: dict[str, str] | None = None,
) -> tuple[dict[str, int], dict[str, int]]:
    """Load dimensions, resolve facts against them, load facts; returns the rows of each.

    ``resolve`` gets the loaded dimensions: fact keys exist only after that load.
    What it stages is removed once the facts are loaded.
    """
    dimension_rows = warehouse.load_dimensions(prepared, truncate, only_new)
    with passing_stages(warehouse.spark):
        facts = resolve(warehouse.tables())
        return dimension_rows, warehouse.load_facts(facts, truncate, observations, only_new, failures)


def run(
    warehouse: Warehouse,
    source: Source,
    files: Frames,
    truncate: bool = False,
    as_of: datetime.date | None = None,
    only_new: bool = False,
    statistics: bool = False,
) -> RunReport:
    """Build the whole warehouse from its sources and check it.

    Without ``truncate`` rows are appended, and stored keys are refused; with
    ``only_new`` stored business keys are left out instead, so that a run over
    grown sources adds what is new.  A fact that fails is reported and does not
    stop the other.  ``extracted`` counts dimension rows in one job of their own and
    fact rows while they are written.  ``lost_values`` counts, for each survey
    column that lost any, texts cut to its width and values not of its type.
    ``statistics`` has the loaded tables analyzed for the optimizer at the end.
    """
    creation = warehouse.create()
    extraction = extract_all(source, as_of, LOAD_EXTRACTS)
    for name, cause in extraction.failures.items():
        log.error("extract of %s failed: %s", name, cause)
    raw = {**extraction.frames, **files}
    prepared = prepare(extraction.frames, files)
    missing = {n: extraction.failures.get(n, "not given") for n in DIMENSIONS if n not in prepared}
    if missing:
        raise ValueError(f"missing dimensions: {missing}")

    failures = dict(extraction.failures)
    observed = {name: Observation() for name in FACTS}

    def resolve(dims: Frames) -> Frames:
        return _resolve_facts(source, dims, failures)

    dimension_rows, fact_rows = load_warehouse(warehouse, prepared, resolve, truncate, observed, only_new, failures)
    matches = {name: dict(observed[name].get) for name in fact_rows}
    dropped = {name: counts.pop("dropped_rows") for name, counts in matches.items()}
    counted = extraction_report(warehouse.spark, Extraction({n: raw[n] for n in DIMENSIONS}, {})).collect()
    extracted = {r["table_name"]: r["row_count"] for r in counted}
    extracted |= {name: counts["total_rows"] for name, counts in matches.items()}
    for name, rows in dropped.items():
        if rows:
            log.warning("%s: %d rows without a critical key were dropped", name, rows)
    for place in checks.place_matches(warehouse.tables()).collect():
        matches[place["table_name"]] = {"total_rows": place["total_rows"], "place": place["matched"]}
    for name, counts in matches.items():
        _log_matches(name, counts)
    fact_rows = {name: fact_rows.get(name, 0) for name in FACTS}

    report = checks.table_report(
        warehouse.spark, {n: warehouse.read(n) if warehouse.exists(n) else None for n in (*DIMENSIONS, *FACTS)}
    ).collect()
    orphans = foreign_key_report(warehouse.tables()).collect()
    intact = all(r["orphans"] == 0 for r in orphans if r["decides"])
    ok = sum("OK" in r["status"] for r in report)
    broken = checks.constraint_report(warehouse.tables()).where("violations > 0").collect()
    violations = {f"{r['table_name']}: {r['rule']}": r["violations"] for r in broken}
    repeated = checks.duplicate_lookup_keys(warehouse.tables()).where("duplicated_keys > 0").collect()
    for r in repeated:
        log.warning("%s: %d values of %s stand for several rows", r["table_name"], r["duplicated_keys"], r["alternate_key"])
    lost = {}
    for r in lost_survey_values(source).where("cut > 0 or unreadable > 0").collect():
        lost[f"{r['table_name']}.{r['column_name']}"] = {c: r[c] for c in ("filled", "cut", "unreadable")}
        log.warning("%(table_name)s.%(column_name)s: of %(filled)d values %(cut)d were cut and %(unreadable)d left out", r.asDict())
    held = sum(r["row_count"] for r in report if r["table_name"] in FACTS) if only_new else sum(fact_rows.values())
    if statistics:
        warehouse.analyze()
    return RunReport(
        outcome=checks.run_outcome(held, intact, ok, len(report), sum(violations.values())),
        summary=checks.run_summary(dimension_rows, fact_rows),
        dimension_rows=dimension_rows,
        table_status={r["table_name"]: r["status"] for r in report},
        orphans={r["constraint_name"]: r["orphans"] for r in orphans},
        matches=matches,
        failures=failures,
        violations=violations,
        creation=creation,
        extracted=extracted,
        dropped=dropped,
        duplicate_keys={r["table_name"]: r["duplicated_keys"] for r in repeated},
        lost_values=lost,
    )


def _resolve_facts(source: Source, dims: Frames, failures: dict[str, str]) -> dict[str, DataFrame]:
    """Facts that can be planned; the cause of each that cannot goes to ``failures``.

    Facts are resolved together.  Where that fails they are planned one by one,
    so that only the one at fault is lost.
    """
    together = [FACT_PLANS[name] for name in FACTS if name not in failures]
    if len(together) > 1:
        try:
            return resolve_facts_from_source(source, dims, together)
        except Exception as error:  # one fact must not stop the other
            log.warning("facts cannot be resolved together: %s", error)
    facts = {}
    for name in FACTS:
        if name in failures:
            continue
        try:
            facts[name] = resolve_fact_from_source(source, dims, FACT_PLANS[name])
        except Exception as error:  # one fact must not stop the other
            failures[name] = f"{type(error).__name__}: {error}"
            log.error("%s cannot be built: %s", name, failures[name])
    return facts


def _log_matches(table: str, counts: Mapping[str, int]) -> None:
    total = counts["total_rows"]
    for key, matched in counts.items():
        missed = total - matched
        if key == "total_rows" or missed == 0:
            continue
        if missed == total:
            log.error("%s: no row found its %s", table, key)
        elif missed > total * HIGH_MISS_SHARE:
            log.warning("%s: %d of %d rows found no %s", table, missed, total, key)
        else:
            log.info("%s: %d of %d rows found no %s", table, missed, total, key)

"""Preflight and runs that a configuration describes."""

import datetime

import pytest
from pyspark.sql import functions as F
from small_source import TODAY, source, territories

from starloom.model import TABLES
from starloom.plans import job, preflight
from starloom.plans.warehouse import Warehouse
from starloom.sources import CatalogSource, FrameSource, JdbcSource, ParquetSource


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The small source as Parquet folders, and its territory file."""
    root = tmp_path_factory.mktemp("oltp")
    small = source(spark)
    for name in small.names:
        small.table(name).write.parquet(f"{root}/{name}")
    files = tmp_path_factory.mktemp("files")
    lines = "".join(f"{i}|{'|'.join('' if v is None else str(v) for v in r)}\n" for i, r in enumerate(territories(spark).collect(), 1))
    (files / "DimSalesTerritory.csv").write_text(lines, encoding="utf-16")
    return root, files


def configuration(stored, tmp_path, **load):
    root, files = stored
    return {
        "source": {"kind": "parquet", "root": str(root)},
        "files": {"folder": str(files), "first_day": datetime.date(2024, 1, 1), "last_day": datetime.date(2024, 12, 31)},
        "target": {"database": "dw_job", "location": str(tmp_path / "dw"), "log": "run_log"},
        "load": {"truncate": True, "as_of": TODAY, **load},
    }


@pytest.fixture
def clean(spark):
    yield
    spark.sql("DROP DATABASE IF EXISTS dw_job CASCADE")


def test_source_report(spark):
    small = source(spark)
    tables = {n: (lambda n=n: small.table(n)) for n in small.names}
    tables["Sales.Store"] = lambda: small.table("Sales.Store").drop("Name").withColumnRenamed("BusinessEntityID", "businessentityid")
    del tables["Sales.Customer"]
    report = {r["table_name"]: r for r in preflight.source_report(FrameSource(spark, tables)).collect()}
    assert set(report) == set(preflight.SOURCE_COLUMNS)
    assert report["Sales.Store"]["status"] == "lacks: Name" and report["Sales.Store"]["row_count"] == 3
    assert report["Sales.Customer"]["status"].startswith("unreachable: KeyError") and report["Sales.Customer"]["row_count"] is None
    assert {r["status"] for n, r in report.items() if n not in ("Sales.Store", "Sales.Customer")} == {"ok"}


def test_every_table_that_the_extracts_read_is_looked_at(spark):
    small, asked = source(spark), set()

    class Listening(FrameSource):
        def table(self, name):
            asked.add(name)
            return super().table(name)

    from starloom.plans.extracts import EXTRACTS, extract_all

    extract_all(Listening(spark, {n: small.table(n) for n in small.names}), TODAY, EXTRACTS)
    assert asked == set(preflight.SOURCE_COLUMNS)


def test_target_state_and_probe_times(spark, tmp_path, clean):
    made = Warehouse(spark, "dw_job", str(tmp_path / "dw"))
    before = preflight.target_state(made)
    assert not before.is_present and before.missing == tuple(TABLES) and before.version == spark.version
    made.create()
    spark.sql("DROP TABLE dw_job.dim_currency")
    after = preflight.target_state(made)
    assert after.is_present and after.missing == ("dim_currency",) and len(after.found) == 13
    times = preflight.probe_times(source(spark), made, since="2024-01-01")
    assert times["target tables"][1] == 13 and times["source lines"][1] > 0 and all(t > 0 for t, _ in times.values())


def test_a_job_runs_and_logs(spark, stored, tmp_path, clean):
    done = job.run_job(spark, configuration(stored, tmp_path))
    assert done.report.outcome == "warnings" and done.exit_code == 1
    assert done.report.summary["fact_stats"] == {"fact_internet_sales": 4, "fact_reseller_sales": 2}
    assert done.source_rows["Sales.Customer"] == 7 and not done.target.is_present
    done.run_id, first = "again", done.run_id
    job.log_run(Warehouse(spark, "dw_job"), done, "run_log")
    log = spark.table("dw_job.run_log")
    loaded = log.where("section = 'loaded' and name = 'fact_internet_sales'")
    assert {(r["run_id"], r["value"]) for r in loaded.collect()} == {(first, 4), ("again", 4)}
    lost = log.where("section = 'lost in dim_customer.total_children' and name = 'unreadable'")
    assert lost.agg(F.sum("value")).first()[0] == 2
    told = job.text(done)
    assert "fact_internet_sales: 4 rows loaded, 4 dropped, OK" in told and "outcome: warnings" in told


def test_preflight_stops_before_anything_changes(spark, stored, tmp_path, clean):
    config = configuration(stored, tmp_path)
    checked = job.run_job(spark, config, check_only=True)
    assert checked.report is None and checked.exit_code == 0 and "to be created" in job.text(checked)
    config["source"]["root"] = str(tmp_path)
    with pytest.raises(preflight.PreflightError, match="Sales.SalesOrderHeader unreachable"):
        job.run_job(spark, config)
    assert not spark.catalog.databaseExists("dw_job")


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"source": {"kind": "csv"}}, "source.kind"),
        ({"source": {"kind": "parquet"}}, "source.root"),
        ({"files": {}}, "files.folder"),
        ({"files": {"folder": "x", "first_day": datetime.date(2024, 1, 1)}}, "last_day"),
        ({"load": {"trunkate": True}}, "load.trunkate"),
        ({"sink": {}}, "sink"),
    ],
)
def test_wrong_configurations(change, message):
    whole = {"source": {"kind": "catalog"}, "files": {"folder": "x"}}
    with pytest.raises(job.ConfigError, match=message):
        job.checked_config({**whole, **change})


def test_sources_of_each_kind(spark, monkeypatch):
    assert isinstance(job.source_of(spark, {"kind": "parquet", "root": "x"}), ParquetSource)
    assert isinstance(job.source_of(spark, {"kind": "catalog"}), CatalogSource)
    section = {"kind": "jdbc", "url": "jdbc:x", "user": "u", "password_variable": "STARLOOM_TEST", "small": ["A.B"], "splits": {"C.D": ["id", 1, 9, 3]}}
    with pytest.raises(job.ConfigError):
        job.source_of(spark, section)
    monkeypatch.setenv("STARLOOM_TEST", "secret")
    made = job.source_of(spark, section)
    assert isinstance(made, JdbcSource) and made.options("C.D")["numPartitions"] == "3"
    assert made.options("A.B") == {"url": "jdbc:x", "fetchsize": "10000", "user": "u", "password": "secret", "dbtable": "A.B"}


def test_command_line(spark, stored, tmp_path, clean, capsys):
    root, files = stored
    path = tmp_path / "job.toml"
    path.write_text(
        f'[source]\nkind = "parquet"\nroot = "{root}"\n[files]\nfolder = "{files}"\nfirst_day = 2024-01-01\nlast_day = 2024-12-31\n'
        f'[target]\ndatabase = "dw_job"\nlocation = "{tmp_path}/dw"\n[load]\nas_of = 2024-01-29\n'
    )
    assert job.main([str(path), "--check"]) == 0 and "source: 27 tables" in capsys.readouterr().out
    assert job.main([]) == 2 and job.main([str(path), "--what"]) == 2 and job.main([str(tmp_path / "none.toml")]) == 2
    path.write_text('[source]\nkind = "parquet"\n')
    assert job.main([str(path)]) == 2 and "source.root" in capsys.readouterr().out

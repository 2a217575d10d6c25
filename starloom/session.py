"""Session settings and the shared folder that survives executor loss."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on.  Joins carry no broadcast hints: Spark compares
# real sizes with the threshold, and AQE splits hot join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}

_local_folder: dict[str, str] = {}
_stages: ContextVar[str | None] = ContextVar("stages", default=None)


def local_session(cores: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(extra.pop("partitions", 8)))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="starloom-tables-"))
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("FATAL")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is made, but only for a
    local master: on a cluster a machine-local folder would vanish with its host.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="starloom-")
    return _local_folder[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{_stages.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def passing_stages(spark: SparkSession) -> Iterator[None]:
    """What this thread writes through inside the block is removed when the block ends."""
    folder = new_folder(spark, "passing")
    token = _stages.set(folder)
    try:
        yield
    finally:
        _stages.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_through(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting its lineage.

    Parquet rather than ``checkpoint()``: later readers prune columns and get
    real sizes for join planning.
    """
    path = new_folder(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Adaptive execution picks partition counts, join strategies and skew splits at run time.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

#: Fixed when a session starts: wide plans are built faster without call-site capture.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators are written for to a session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cpus: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**START_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def cut_lineage(df: DataFrame, observed: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Write a table to the shared folder named by ``spark.checkpoint.dir`` and read it back.

    A written table has a true size; a checkpointed plan keeps the estimate of its lineage, which
    multiplies with every join of a loop. Only a local session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, because executors cannot share a local folder. ``observed`` comes last, behind any
    shuffle, because adaptive execution drops what lies below the shuffle of an empty table.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="kinfold-checkpoint-")
        sc.setCheckpointDir(folder)
    name = uuid.uuid4().hex
    path = f"{folder}/kinfold/rounds/{name}"
    together = _TOGETHER.get()
    if together and together[0] in df.columns:
        return _cut_buckets(df, observed, f"kinfold_{name}", path, *together)
    observed(df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Column and number of buckets of the tables that are cut now, or None.
_TOGETHER: ContextVar[tuple[str, int] | None] = ContextVar("together", default=None)


@contextmanager
def kept_together(spark: SparkSession, column: str, buckets: int) -> Iterator[None]:
    """In this block tables with ``column`` are cut into buckets of it, and joins, windows and sums over it and other columns stay in them.

    So rows are shuffled when they first come together and not in every step. For groups that are small beside a bucket.
    """
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    token = _TOGETHER.set((column, buckets))
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)
        _TOGETHER.reset(token)


def is_kept_together() -> bool:
    return _TOGETHER.get() is not None


def _cut_buckets(
    df: DataFrame, observed: Callable[[DataFrame], DataFrame], name: str, path: str, column: str, buckets: int
) -> DataFrame:
    """``cut_lineage`` into buckets. The catalog knows the table only until it is read."""
    spark = df.sparkSession
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (`{column}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    observed(df.repartition(buckets, column)).write.insertInto(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def cut_measured(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict[str, int]]:
    """``cut_lineage`` and aggregates of the same rows, taken while they are written, so that a loop needs no second job to see its end."""
    seen = Observation()
    out = cut_lineage(df, lambda rows: rows.observe(seen, *[c.alias(n) for n, c in measures.items()]))
    return out, seen.get

"""Session defaults and the scratch area on shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


_RUN: ContextVar[str] = ContextVar("run", default="")
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "cohorts", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="cohorts-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def scratch_dir(spark: SparkSession) -> str:
    """The application's own part of the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/cohorts/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{_RUN.get()}{name}-{uuid.uuid4().hex}"


@contextmanager
def own_scratch(spark: SparkSession) -> Iterator[Callable[[], AbstractContextManager[None]]]:
    """Scratch tables made inside are removed at the end, so no frame built on them may leave the block.

    Tables that must outlive it are written ``with outside():``, where ``outside`` is what the block gives.
    """
    outer = _RUN.get()
    run = f"{outer}run-{uuid.uuid4().hex}/"

    @contextmanager
    def outside() -> Iterator[None]:
        inner = _RUN.set(outer)
        try:
            yield
        finally:
            _RUN.reset(inner)

    mark = _RUN.set(run)
    try:
        yield outside
    finally:
        _RUN.reset(mark)
        _remove(spark, f"{scratch_dir(spark)}/{run}")


def clear_scratch(spark: SparkSession) -> bool:
    """Remove the application's scratch tables, once no frame built on them is needed any more."""
    return _remove(spark, scratch_dir(spark))


def _remove(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def spent_shuffles(spark: SparkSession) -> Iterator[None]:
    """A write inside removes its shuffle files when it ends; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage of loops, survives the loss of executors, keeps column
    pruning, and gives the optimizer real sizes for its join choices. What the write shuffled goes when it ends.
    """
    path = new_path(df.sparkSession, name)
    with spent_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_with(df: DataFrame, name: str, **facts: str) -> tuple[DataFrame, dict]:
    """Like :func:`materialize`, with aggregates (SQL text by name) taken while writing, at no extra pass."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    watched = df.observe(seen, *[F.expr(text).alias(key) for key, text in facts.items()])
    return materialize(watched, name), seen.get

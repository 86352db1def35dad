"""Intermediate results as written tables in the folder the cluster shares, and their tasks."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Codec of the card tables: it halves their hexadecimal keys and ids, which the default leaves as they are.
CODEC = {"compression": "zstd"}
METHOD_LIMIT, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of this session.

    Without one, a session whose executors are threads of this process gets a temporary folder
    for its lifetime; on a cluster that would be another disk on each machine, so it is an error.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(
                f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share"
            )
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cardwarden-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


_run: ContextVar[str] = ContextVar("scratch_run", default="")


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Copies made inside lie in a folder of this run, which goes at the end, also on failure."""
    folder = f"{scratch_root(spark)}/cardwarden/run-{uuid.uuid4().hex}"
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    folder = _run.get() or f"{scratch_root(spark)}/cardwarden"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage in a way that survives lost executors, keeps column pruning for later
    readers, and gives the planner the true size, by which it decides about broadcasts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Queries run inside get no generated method that is too long for the JVM to compile.

    The wide parsing projections are; Spark then splits them. A smaller limit of the session stays.
    """
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, min(int(before), METHOD_BYTES))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def materialize_rows(df: DataFrame, label: str) -> DataFrame:
    """:func:`materialize` for card tables: packed, and their projections compiled."""
    with short_methods(df.sparkSession):
        return materialize(df, label, **CODEC)


def materialize_measured(df: DataFrame, label: str, **measures: Column) -> tuple[DataFrame, dict]:
    """Like :func:`materialize_rows`, with aggregates over all rows that are taken while they are written.

    Saves a pass over the copy for each of them. A task that is run again counts once.
    """
    seen = Observation()
    written = materialize_rows(df.observe(seen, *[m.alias(name) for name, m in measures.items()]), label)
    return written, seen.get


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out over all cores, for work that is heavy per row and few input files."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)

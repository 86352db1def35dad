"""A local session for tests and benchmarks. On a cluster, use the session it gives you."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str | int, folder: str) -> SparkSession:
    """Session on this machine with its tables and scratch files under ``folder``.

    Methods of generated code beyond 8000 bytes are never compiled by the JVM's JIT. The wide
    projections here pass that size, so Spark is told to split them instead.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cardwarden")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/checkpoint")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

"""Publication by pointer: new content is written once, checked, and then takes over the name.

A table's next version is prepared beside it as ``…__next``. A table by months is external: its
months are folders of their own, and a version is a set of pointers to them, so preparing one
writes the touched months only. Releasing renames; until then readers see the old version whole.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.operators.staging import PARTITION
from cardwarden.sources import files
from cardwarden.sources.scratch import CODEC, short_methods

#: Partitions that one statement adds.
AT_ONCE = 100
#: A month may lie in so many files, and in one more for each of so many bytes.
FEW_FILES = 8
FILE_BYTES = 2**24


def next_name(table: str) -> str:
    return f"{table}__next"


def _folder(spark: SparkSession, table: str, kind: str) -> str:
    database, name = table.split(".")
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}__{kind}"


def month_folders(spark: SparkSession, table: str) -> dict[str, str]:
    """Where each month of a table lies."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        column, month = row.partition.split("=", 1)
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({column} = '{month}')").collect()
        found[month] = next(r.data_type for r in told if r.col_name == "Location")
    return found


def is_by_months(spark: SparkSession, table: str) -> bool:
    """Whether ``table`` exists as an external table of month folders."""
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "EXTERNAL"


def scattered_months(spark: SparkSession, table: str) -> set[str]:
    """Months that lie in many files which are small: in more than their bytes and some loads explain."""
    found = set()
    for month, path in month_folders(spark, table).items():
        n_files, n_bytes = files.extent(spark, path)
        if n_files > FEW_FILES + n_bytes / FILE_BYTES:
            found.add(month)
    return found


def by_month(rows: DataFrame | None, column: str, *order: str, gathered: DataFrame | None = None) -> DataFrame:
    """Rows gathered by month for writing: few files a month, and a big month in many tasks.

    Files are sorted by ``order``, so that a reader's limits on it skip parts of a month.
    ``gathered`` are rows read from a table by months with the same months and no shuffle since:
    they are not shuffled again, as a task that read few months writes few files.
    """
    parts = [] if rows is None else [rows.hint("rebalance", F.col(column))]
    if gathered is not None:
        parts.append(gathered)
    return reduce(DataFrame.unionByName, parts).sortWithinPartitions(column, *order)


def prepare(df: DataFrame, table: str) -> DataFrame:
    """The next version of a table, whole."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {next_name(table)}")
    df.write.options(**CODEC).saveAsTable(next_name(table))
    return spark.table(next_name(table))


def prepare_months(
    df: DataFrame | None,
    table: str,
    months: set[str] | None,
    *order: str,
    column: str = PARTITION,
    gathered: DataFrame | None = None,
) -> DataFrame:
    """The next version of a table by months: ``df`` in place of ``months``, all others as they are.

    Its months are the values of ``column``.

    ``df`` and ``gathered`` (see :func:`by_month`) hold the whole new content of these months; a
    month without rows leaves the table. None stands for all months. Files are written once; the
    other months are only pointed to.
    """
    rows = by_month(df, column, *order, gathered=gathered)
    spark = rows.sparkSession
    coming, root = next_name(table), _folder(spark, table, "data")
    spark.sql(f"DROP TABLE IF EXISTS {coming}")
    kept: dict[str, str] = {}
    if is_by_months(spark, table):
        kept = month_folders(spark, table)
        vacuum(spark, table, kept)
    elif spark.catalog.tableExists(table) and months is not None:
        raise ValueError(f"{table} is not a table of month folders; prepare all its months")
    folder = f"{root}/{uuid.uuid4().hex}"
    with short_methods(spark):
        rows.write.options(**CODEC).partitionBy(column).parquet(folder)
    pointers = {m: path for m, path in kept.items() if months is not None and m not in months}
    for path in files.children(spark, folder):
        name = path.rsplit("/", 1)[1]
        if name.startswith(f"{column}="):
            pointers[name.removeprefix(f"{column}=")] = path
    fields = [f for f in rows.schema.fields if f.name != column]
    empty = spark.createDataFrame([], type(rows.schema)([*fields, rows.schema[column]]))
    empty.write.option("path", f"{folder}/_table").partitionBy(column).saveAsTable(coming)
    parts = [f"PARTITION ({column} = '{m}') LOCATION '{path}'" for m, path in sorted(pointers.items())]
    for start in range(0, len(parts), AT_ONCE):
        spark.sql(f"ALTER TABLE {coming} ADD {' '.join(parts[start:start + AT_ONCE])}")
    spark.catalog.refreshTable(coming)
    return spark.table(coming)


def vacuum(spark: SparkSession, table: str, live: dict[str, str] | None = None) -> int:
    """Remove month folders that the table no longer points to; returns their number.

    Run before a new version is prepared, so the version before the present one stays readable
    until then.
    """
    used = {path.rstrip("/") for path in (live or month_folders(spark, table)).values()}
    removed = 0
    for version in files.children(spark, _folder(spark, table, "data")):
        months = [p for p in files.children(spark, version) if "=" in p.rsplit("/", 1)[1]]
        stale = [p for p in months if p not in used]
        if len(stale) == len(months):
            files.remove(spark, version)
        else:
            for path in stale:
                files.remove(spark, path)
        removed += len(stale)
    return removed


def swap(spark: SparkSession, table: str) -> None:
    """Let the prepared version take over the name. Repeating it gives the same table."""
    coming, last = next_name(table), f"{table}__last"
    if spark.catalog.tableExists(coming):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE IF EXISTS {last}")
            spark.sql(f"ALTER TABLE {table} RENAME TO {last}")
        spark.sql(f"ALTER TABLE {coming} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {last}")
    spark.catalog.refreshTable(table)


def _journal(spark: SparkSession, database: str) -> str:
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/releases__open"


def open_release(spark: SparkSession, tables: list[str]) -> str:
    """Note that these prepared tables are whole and checked: from here on they will take over."""
    path = f"{_journal(spark, tables[0].split('.')[0])}/{uuid.uuid4().hex}"
    files.write_text(spark, path, json.dumps(tables))
    return path


def finish_release(spark: SparkSession, path: str, tables: list[str]) -> None:
    for table in tables:
        swap(spark, table)
    files.remove(spark, path)


def release(spark: SparkSession, tables: list[str]) -> None:
    """Swap in all the prepared tables; what a lost driver leaves half done, :func:`recover` finishes."""
    finish_release(spark, open_release(spark, tables), tables)


def recover(spark: SparkSession, database: str, table: str | None = None) -> int:
    """Finish the releases of a database, or of one table, that were cut off; returns their number."""
    finished = 0
    for path in files.children(spark, _journal(spark, database)):
        if path.endswith("_draft"):  # the note itself was cut off: nothing was released
            files.remove(spark, path)
            continue
        tables = json.loads(files.read_text(spark, path))
        if table is None or table in tables:
            finish_release(spark, path, tables)
            finished += 1
    return finished

"""Folders and small files through the file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, folder: str) -> list[str]:
    """Full names of what lies in a folder; nothing if there is none."""
    fs, path = file_system(spark, folder), _path(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(status.getPath().toString() for status in fs.listStatus(path))


def extent(spark: SparkSession, folder: str) -> tuple[int, int]:
    """Number of files in a folder and their bytes."""
    found = file_system(spark, folder).getContentSummary(_path(spark, folder))
    return found.getFileCount(), found.getLength()


def remove(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(_path(spark, path), True)


def create_new(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if there is one already. The file system decides between two callers."""
    return file_system(spark, path).createNewFile(_path(spark, path))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there whole or not at all."""
    fs, draft = file_system(spark, path), _path(spark, path + "_draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(draft, _path(spark, path))


def read_text(spark: SparkSession, path: str) -> str:
    data = file_system(spark, path).open(_path(spark, path))
    try:
        return bytes(data.readAllBytes()).decode()
    finally:
        data.close()


def move(spark: SparkSession, path: str, to: str) -> bool:
    fs = file_system(spark, path)
    return fs.exists(_path(spark, path)) and fs.rename(_path(spark, path), _path(spark, to))


def touch(spark: SparkSession, path: str, millis: int) -> None:
    file_system(spark, path).setTimes(_path(spark, path), millis, -1)


def changed_at(spark: SparkSession, path: str) -> int | None:
    """Time of the last change in milliseconds; None without such a file, also if it goes meanwhile."""
    found = file_system(spark, path).globStatus(_path(spark, path))
    return found[0].getModificationTime() if found else None

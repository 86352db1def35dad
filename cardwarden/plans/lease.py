"""One writer a table: a lease that a file in the table's database stands for."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from cardwarden.sources import files

#: Seconds without a sign of life after which a lease counts as lost.
STALE = 120.0
#: Seconds to wait for another writer.
PATIENCE = 3600.0


class TableBusyError(RuntimeError):
    """Another writer did not let go of the table in time."""


def lease_path(spark: SparkSession, table: str) -> str:
    database, name = table.split(".")
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}__lease"


@contextmanager
def writer_lease(
    spark: SparkSession, table: str, patience: float = PATIENCE, stale: float = STALE
) -> Iterator[None]:
    """Hold the only right to write ``table``; wait for another holder up to ``patience`` seconds.

    The holder renews the file while it works. A file that was not renewed for ``stale`` seconds
    belongs to a lost driver: one of the waiting writers moves it away. Machines' clocks must
    agree within that time. Needs a file system whose creation of a file is atomic.
    """
    path = lease_path(spark, table)
    deadline = time.monotonic() + patience
    while not files.create_new(spark, path):
        changed = files.changed_at(spark, path)
        if changed is not None and time.time() * 1000 - changed > stale * 1000:
            lost = f"{path}_{uuid.uuid4().hex}"
            if files.move(spark, path, lost):
                files.remove(spark, lost)
            continue
        if time.monotonic() > deadline:
            raise TableBusyError(f"{table} is being written by another load")
        time.sleep(min(0.2, stale / 10))
    done = threading.Event()

    def renew() -> None:
        while not done.wait(stale / 4):
            files.touch(spark, path, int(time.time() * 1000))

    alive = threading.Thread(target=renew, daemon=True)
    alive.start()
    try:
        yield
    finally:
        done.set()
        alive.join()
        files.remove(spark, path)

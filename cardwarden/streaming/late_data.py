"""Late and corrected records: landed pages as a stream, upserted batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cardwarden.operators import bronze
from cardwarden.operators.normalize import flatten, normalize_records
from cardwarden.sources.schemas import LANDING_PARTITIONS, RAW_RECORD
from cardwarden.sources.scratch import materialize_rows, scratch_run


def upsert_batch(load_prefix: str, table: str = bronze.BRONZE_TABLE):
    """Sink function: the batch number makes the load id, and a batch in the ledger is not taken twice.

    A batch that was cut off before its entry is repeated, which changes nothing. The copy of a
    batch is removed with it.

    Load ids are compared as text. With an ISO day as ``load_prefix`` the stream's loads follow
    that day's batch load and precede the next day's: "2026-09-30" < "2026-09-30.000000001".
    """

    def write(batch: DataFrame, number: int) -> None:
        load_id = f"{load_prefix}.{number:09d}"
        with scratch_run(batch.sparkSession):
            rows = materialize_rows(flatten(normalize_records(batch.drop("mes", "pagina")), load_id), "batch")
            if not rows.isEmpty():
                bronze.upsert(rows, table, load_id, once=True)

    return write


def stream_landing(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    load_prefix: str,
    table: str = bronze.BRONZE_TABLE,
    whole_files: bool = True,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Upsert every file that appears under the landing folder, once.

    The state is the bronze table itself: a record may arrive however late, so there is no
    watermark. Runs until the files at hand are done.
    """
    source = (
        spark.readStream.schema(f"{RAW_RECORD}, {LANDING_PARTITIONS}")
        .option("multiLine", whole_files)
    )
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    return (
        source.json(root)
        .writeStream.foreachBatch(upsert_batch(load_prefix, table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

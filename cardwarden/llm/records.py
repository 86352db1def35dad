"""Token ids as length-delimited binary records with masked checksums and an offset index.

A data file is a row of frames: length (uint64), masked CRC-32C of the length (uint32), payload,
masked CRC-32C of the payload (uint32), all little-endian. A payload is the id (int64), 1 if there
is an id (uint8), the bytes of a token id, 2 or 4 (uint8), then the token ids. Beside each data file stands an
index of uint64 offsets, one for each frame, by which single records can be read in any order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwarden.llm.common import file_system, parts_of, shuffle_shards, texts_of
from cardwarden.llm.crc32c import crc32c, masked
from cardwarden.llm.tokens import merge_model
from cardwarden.sources.scratch import materialize, scratch_path

HEAD = np.dtype([("length", "<u8"), ("check", "<u4")])
OWN = np.dtype([("id", "<i8"), ("has_id", "u1"), ("width", "u1")])
#: Bytes of frames that are checked together.
FLUSH = 8 << 20
MANIFEST = "part int, path string, n_records bigint, n_ids bigint, n_bytes bigint"


def frames(payloads: list[bytes]) -> list[bytes]:
    heads = np.zeros(len(payloads), HEAD)
    heads["length"] = [len(p) for p in payloads]
    lengths = [h.tobytes() for h in heads["length"]]
    heads["check"] = masked(crc32c(lengths))
    checks = masked(crc32c(payloads)).astype("<u4")
    return [h.tobytes() + p + c.tobytes() for h, p, c in zip(heads, payloads, checks, strict=True)]


def payloads_of(block: bytes) -> list[bytes]:
    """Payloads of whole frames; raises if a checksum does not fit."""
    out, lengths, checks, at = [], [], [], 0
    while at < len(block):
        head = np.frombuffer(block, HEAD, 1, at)[0]
        length, at = int(head["length"]), at + HEAD.itemsize
        if at + length + 4 > len(block):
            raise ValueError("a record is cut off")
        lengths.append((block[at - HEAD.itemsize:at - 4], head["check"]))
        out.append(block[at:at + length])
        checks.append(np.frombuffer(block, "<u4", 1, at + length)[0])
        at += length + 4
    wrong = masked(crc32c([x for x, _ in lengths])) != np.array([c for _, c in lengths], np.uint32)
    if wrong.any() or (masked(crc32c(out)) != np.array(checks, np.uint32)).any():
        raise ValueError("a record's checksum does not fit")
    return out


def write_records(
    docs: DataFrame, folder: str, model_path: str, end_id: int, id_col: str = "doc_id",
    text_col: str = "text", parts: int | None = None,
) -> DataFrame:
    """Write the documents' ids in ascending order of id; one manifest row for each file.

    Documents are dealt by ranges of their id (rows with equal ids by a hash of their text), so
    that the files in the order of their number hold all documents in order. Each task writes a
    file of its own under a name of that attempt and then gives it its final name, so that a
    repeated task replaces what a lost one left.
    """
    parts = parts or shuffle_shards(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("_h", F.xxhash64("text")).repartitionByRange(parts, "id", "_h")
    rows = rows.sortWithinPartitions("id", "_h").select("id", "text")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = merge_model(model_path)
        kind, width = model.kind, np.dtype(model.kind).itemsize
        end = np.array([end_id], kind).tobytes()
        task = TaskContext.get()
        part = task.partitionId()
        store, root = file_system(folder)
        store.create_dir(root, recursive=True)
        name = f"{root}/part-{part:06d}"
        own = f"{root}/_attempt-{part:06d}-{task.taskAttemptId()}"
        offsets, n_ids, at, ready, size = [], 0, 0, [], 0
        out = None

        def flush():
            nonlocal at, ready, size
            for frame in frames(ready):
                offsets.append(at)
                out.write(frame)
                at += len(frame)
            ready, size = [], 0

        for batch in batches:
            coded_texts = (c for part in parts_of(texts_of(batch, "text")) for c in model.encode(part))
            for key, coded in zip(batch["id"], coded_texts, strict=True):
                if out is None:
                    out = store.open_output_stream(f"{own}.rec")
                ids = coded + end
                has_id = not pd.isna(key)
                own_part = np.array([(int(key) if has_id else 0, has_id, width)], OWN).tobytes()
                ready.append(own_part + ids)
                n_ids += len(ids) // width
                size += len(ready[-1])
                if size >= FLUSH:
                    flush()
        if out is None:
            return
        flush()
        out.close()
        with store.open_output_stream(f"{own}.idx") as index:
            index.write(np.array(offsets, "<u8").tobytes())
        for ending in (".rec", ".idx"):
            store.move(own + ending, name + ending)
        yield pd.DataFrame({
            "part": [part], "path": [name], "n_records": [len(offsets)], "n_ids": [n_ids], "n_bytes": [at],
        })

    return materialize(rows.mapInPandas(write, MANIFEST), "manifest")


def _read_part(folder: str, path: str) -> Iterator[tuple[list[bytes], int]]:
    """Checked payloads of a file, several MB at a time, found by its index."""
    store, _ = file_system(folder)
    with store.open_input_file(f"{path}.idx") as index:
        offsets = np.frombuffer(index.read(), "<u8").astype(np.int64)
    with store.open_input_file(f"{path}.rec") as data:
        bounds = np.append(offsets, data.size())
        first = 0
        while first < len(offsets):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + FLUSH, "right")) - 1)
            data.seek(int(bounds[first]))
            yield payloads_of(data.read(int(bounds[last] - bounds[first])))
            first = last


def read_record(folder: str, path: str, number: int) -> tuple[int | None, np.ndarray]:
    """One record, found by its place in the index: (id, token ids)."""
    store, _ = file_system(folder)
    with store.open_input_file(f"{path}.idx") as index:
        index.seek(8 * number)
        at = int(np.frombuffer(index.read(8), "<u8")[0])
    with store.open_input_file(f"{path}.rec") as data:
        data.seek(at)
        head = data.read(HEAD.itemsize)
        length = int(np.frombuffer(head, HEAD, 1)[0]["length"])
        (payload,) = payloads_of(head + data.read(length + 4))
    return sequence(payload)


def sequence(payload: bytes) -> tuple[int | None, np.ndarray]:
    own = np.frombuffer(payload, OWN, 1)[0]
    kind = "<u2" if own["width"] == 2 else "<u4"
    ids = np.frombuffer(payload, kind, -1, OWN.itemsize)
    return (int(own["id"]) if own["has_id"] else None), ids


def read_records(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file, record), one row a record, from the files."""
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row a file
    first = F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("bigint")
    listed = manifest.withColumn("first", first).repartition(shuffle_shards(spark), "part")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, at, n_records in zip(batch["path"], batch["first"], batch["n_records"], strict=True):
                number = 0
                for payloads in _read_part(folder, path):
                    rows = []
                    for payload in payloads:
                        key, ids = sequence(payload)
                        rows.append((key, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), path, number))
                        at, number = at + len(ids), number + 1
                    frame = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32", "file", "record"])
                    frame["doc_id"] = frame["doc_id"].astype("Int64")
                    yield frame
                if number != n_records:
                    raise ValueError(f"{path} has {number} of {n_records} records")

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, file string, record bigint"
    return listed.select("path", "first", "n_records").mapInPandas(read, schema)


def binary_output(
    docs: DataFrame, model_path: str, end_id: int = 1, folder: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write all documents as records and return what the files hold, one row a document.

    ``start`` counts the ids of all documents before it in ascending order of id (rows with equal
    ids in the order of a hash of their text, NULL ids first), ``n_tokens`` the document's ids with
    the end id, ``ids_crc32`` is zlib's checksum of the ids as little-endian uint32. NULL and empty
    texts are one end id. Repeated rows are each written. An empty table writes no file. Other
    columns are ignored. ``folder`` must be shared by all machines; unset, it is a new one in the
    session's checkpoint folder.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "records")
    manifest = write_records(docs, folder, model_path, end_id, id_col, text_col)
    found = read_records(spark, folder, manifest)
    return found if id_col == "doc_id" else found.withColumnRenamed("doc_id", id_col)

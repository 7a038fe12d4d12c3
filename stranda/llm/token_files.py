"""Token ids of whole texts in binary files, and the documents read back from them.

Texts are range-partitioned by doc_id, so that the files hold documents in ascending doc_id order (null
doc_ids first; rows with equal doc_ids in the order of their texts). Each task encodes its own range
and streams it into one file of its own name; the table of files is written by Spark, so exactly the files
of the attempts that Spark has accepted belong to the result, whatever executors are lost.
A null or empty text has no ids of its own. An empty table gives no files and no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import gathered, materialize, shared_path, small_batches, text_bytes
from .simple8b import Reader, Writer
from .tokens import encoder, vocabulary

FILES = "part int, path string, n_docs long, n_ids long, n_bytes long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def open_store(uri: str):
    """File system and path for a folder that executors share: file:, hdfs:, s3:, gs: and what else Arrow opens."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """``end_id`` after the ids of each text."""
    if end_id is None:
        return ids, counts
    ends = np.cumsum(counts)
    return np.insert(ids, ends, np.uint32(end_id)), counts + 1


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int | None = 1
) -> DataFrame:
    """Encode ``docs`` (doc_id, text, ...) into files below ``folder``; returns the table of files in order."""
    spark = docs.sparkSession
    small_batches(spark)
    path = tokenizer or vocabulary()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = out = writer = None
        part = TaskContext.get().partitionId()
        for batch in gathered(batches):
            if writer is None:
                store, base = open_store(folder)
                store.create_dir(base, recursive=True)
                name = f"{base}/part-{part:06d}-{uuid.uuid4().hex}.s8b"
                out = store.open_output_stream(name)
                writer = Writer(out)
            ids, counts = with_ends(*encoder(path).encode(batch.column("_bytes").to_pylist()), end_id)
            writer.add(batch.column("doc_id").to_pylist(), ids, counts)
        if writer is not None:
            n_docs, n_ids = writer.close()
            out.close()
            row = {"part": part, "path": name, "n_docs": n_docs, "n_ids": n_ids, "n_bytes": store.get_file_info(name).size}
            yield pa.RecordBatch.from_pylist(
                [row], pa.schema([("part", pa.int32()), ("path", pa.string()), *((k, pa.int64()) for k in ("n_docs", "n_ids", "n_bytes"))])
            )

    rows = text_bytes(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "_bytes")
    files = materialize(ordered.mapInArrow(write, FILES), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """A row for each document of the files: doc_id, start, n_tokens, ids_crc32 (of little-endian 32-bit ids)."""
    schema = pa.schema([(c.split()[0], pa.int64()) for c in DOCUMENTS.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["path"]) as file:
                    reader, start, out = Reader(file, row["n_bytes"]), row["first"], []
                    for doc_id, ids in reader.documents():
                        out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                for k in range(0, len(out), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*out[k : k + 10_000], strict=True)], schema=schema
                    )

    # a task for each file; the rows come from one task and are dealt in turn
    spread = files.repartition(max(1, files.count()))
    return spread.mapInArrow(read, DOCUMENTS)


def encode_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = 1) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and return the documents read back from them."""
    folder = shared_path(docs.sparkSession, "token-ids")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id), folder)

"""Shared folder, table access and Arrow batch limits for the operators of this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import make_importable
from . import words

#: Rows of one Arrow batch sent to a Python worker. Small, because one text may be very long.
ARROW_ROWS = 256
#: Bytes of text that are put together for a step whose cost falls with the size of its batch.
GATHERED_BYTES = 2 << 20

_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and every executor see.

    It is the cluster's ``spark.checkpoint.dir``; only where that is unset (a local session, as in
    tests) a temporary folder takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))
    return path


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _clean() -> None:
    while _written:
        spark, path = _written.pop()
        try:
            _delete(spark, path)
        except Exception:  # the session has ended; the folder's owner removes what is left
            return


#: Whether Spark deletes the shuffle files of a query when it ends; nothing reads those of a written table again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def settled(name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``materialize`` of what ``make`` returns; the tables written on the way are deleted then."""
    start = len(_written)
    df = materialize(make(), name)
    for spark, path in _written[start:-1]:
        _delete(spark, path)
    del _written[start:-1]
    return df


#: Rows of one key that are joined in one place, and the most keys with more that are told apart (their number is broadcast).
BLOCK, LARGE_KEYS = 256, 1 << 16


def large_keys(rows: DataFrame, key: str) -> DataFrame:
    """``key`` and ``blocks`` for the keys of ``rows`` (written) that have more than BLOCK rows, LARGE_KEYS keys at most."""
    least = max(BLOCK, rows.count() // LARGE_KEYS)
    sizes = rows.groupBy(key).agg(F.count("*").alias("size")).filter(F.col("size") > least)
    return F.broadcast(materialize(sizes.select(key, F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "large-keys"))


def dealt(rows: DataFrame, large: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` with ``block``: rows of a large key are dealt by the hash of ``by``, so one key is joined in many places."""
    block = F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64(by), "blocks").cast("int"))
    return rows.join(large, key, "left").withColumn("block", block).drop("blocks")


def repeated(rows: DataFrame, large: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``block``: once for each block of their key."""
    every = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    return rows.join(large, key, "left").withColumn("block", every).drop("blocks")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Before Python work: bound the rows of an Arrow batch, so that one of very long texts still fits a worker."""
    make_importable(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_bytes(df: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """The key columns and the whole text as UTF-8 bytes; a null text is empty."""
    return df.select(*[F.col(k) for k in keys], F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_bytes"))


def gathered(batches: Iterator[pa.RecordBatch], least: int = GATHERED_BYTES) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches put together until their texts (``_bytes``) have ``least`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column("_bytes").nbytes
        if size >= least:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def release() -> None:
    """Give memory that a worker process no longer uses back to the system."""
    words.forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work`` for one task, after which its process is left idle and small."""

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release()

    return run

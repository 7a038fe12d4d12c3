"""Sharding by best-fit-decreasing packing of indivisible groups into a fixed number of shards.

Documents with equal texts form a group and stay together. The shards' common capacity is the smallest
at which best-fit-decreasing needs no more shards than allowed, so their sizes are as near to equal as
indivisible groups permit.

Only a bounded number of items reaches the driver, whatever the input: groups larger than
``total / (shards * items_per_shard)`` are items of their own (there are at most
``shards * items_per_shard`` of them) and all smaller groups are dealt by the hash of their text into as
many bundles. Document rows are never gathered and texts are never shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SHARDS = 24
ITEMS_PER_SHARD = 500
#: Ranges within a shard that are numbered apart from each other, so that a shard is never one task.
SLOT_RANGES = 64


def best_fit_decreasing(items: list[tuple[int, int]], capacity: int) -> list[list[int]]:
    """Bins of item keys for ``(size, key)`` items; the largest first, each into the tightest bin that takes it.

    Remaining capacities are kept in sorted order, as in a balanced tree: the tightest bin is found by
    binary search.
    """
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for size, key in sorted(items, key=lambda x: (-x[0], x[1])):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = max(capacity, size), len(bins)
            bins.append([])
        bins[b].append(key)
        insort(room, (left - size, b))
    return bins


def pack_evenly(items: list[tuple[int, int]], shards: int) -> list[list[int]]:
    """Best-fit-decreasing at the smallest capacity that needs at most ``shards`` bins."""
    total = sum(s for s, _ in items)
    low = max([-(-total // shards), *(s for s, _ in items)], default=0)
    high, best = low, best_fit_decreasing(items, low)
    step = max(1, low // 1000)
    while len(best) > shards:
        low, high, step = high + 1, high + step, step * 2
        best = best_fit_decreasing(items, high)
    while low < high:
        mid = (low + high) // 2
        got = best_fit_decreasing(items, mid)
        if len(got) <= shards:
            high, best = mid, got
        else:
            low = mid + 1
    return best + [[] for _ in range(shards - len(best))]


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, items_per_shard: int = ITEMS_PER_SHARD, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Give every row of ``docs`` (doc_id, text, ...) a shard and a gapless slot in it.

    Size: UTF-8 bytes of the text plus 8; a null text has none and groups with empty ones. Rows with
    equal texts get one shard, repeated and null doc_ids included. Slots follow doc_id (nulls first)
    within ranges of its hash; ties are ordered by the text's checksum. An empty table gives no rows.
    Columns of ``docs`` other than doc_id, text and those in ``keep`` are ignored.
    """
    spark = docs.sparkSession
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = materialize(
        docs.select(
            "doc_id", *keep, text_size(F.col("text")).alias("size"), F.crc32(raw).alias("text_crc32"), F.md5(raw).alias("_group")
        ),
        "shard-rows",
    )
    sizes = rows.groupBy("_group").agg(F.sum("size").alias("_bytes"))
    total = rows.agg(F.sum("size")).head()[0] or 0
    cut = max(1, total // (shards * items_per_shard))
    bundle = F.pmod(F.xxhash64("_group"), F.lit(shards * items_per_shard))
    large = sizes.filter(F.col("_bytes") > cut)
    # at most shards * items_per_shard groups are larger than the cut
    own = large.orderBy("_group").select("_group", "_bytes").collect()
    loose = (
        sizes.filter(F.col("_bytes") <= cut).groupBy(bundle.alias("b")).agg(F.sum("_bytes").alias("n")).orderBy("b").collect()
    )
    items = [(r["n"], r["b"]) for r in loose] + [(r["_bytes"], shards * items_per_shard + k) for k, r in enumerate(own)]
    placed = {key: s for s, keys in enumerate(pack_evenly(items, shards)) for key in keys}
    to_bundle = spark.createDataFrame([(b, placed[b]) for b in (r["b"] for r in loose)], "_b long, _bundle_shard int")
    to_own = spark.createDataFrame(
        [(r["_group"], placed[shards * items_per_shard + k]) for k, r in enumerate(own)], "_group string, _own_shard int"
    )
    # both tables have at most shards * items_per_shard rows
    dealt = (
        rows.join(F.broadcast(to_own), "_group", "left")
        .withColumn("_b", F.when(F.col("_own_shard").isNull(), bundle))
        .join(F.broadcast(to_bundle), "_b", "left")
        .withColumn("shard", F.coalesce("_own_shard", "_bundle_shard"))
        .withColumn("_range", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLOT_RANGES)).cast("int"))
    )
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("shard", "_range").count().select(
        "shard", "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy("shard", "_range").orderBy("doc_id", "text_crc32")
    # base has shards * SLOT_RANGES rows
    return dealt.join(F.broadcast(base), ["shard", "_range"]).select(
        "doc_id", *keep, "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("_base") + F.row_number().over(within) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """Write ``docs`` (doc_id, text) as Parquet, a folder for each shard, and return the table as written."""
    placed = shard_documents(docs.select("doc_id", "text"), shards)
    keyed = docs.select("doc_id", "text", F.md5(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("_g"))
    of_group = keyed.join(
        placed.select("doc_id", "text_crc32", "shard").distinct(),
        (keyed["doc_id"].eqNullSafe(placed["doc_id"]))
        & (F.crc32(F.coalesce(keyed["text"].cast("binary"), F.lit(b""))) == placed["text_crc32"]),
    )
    of_group.select(keyed["doc_id"], "text", "shard").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)

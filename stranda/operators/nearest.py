"""Nearest sites at a distance, and nearest of a list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Bases of a bin; sites and anchors meet within one.
BIN = 1 << 16


def _as_of(anchors: DataFrame, sites: DataFrame, at: Column, forwards: bool, bin_size: int) -> DataFrame:
    """For each anchor row the site nearest to ``at`` on one side, as ``_site``.

    One sorted pass over the anchors and sites of a bin. Where a bin has none on that side, the nearest site of another bin is
    carried over: from one row for each bin that has anchors or sites, in a pass over the bins of a contig.
    """
    a = anchors.select("*", at.alias("_at"), F.lit(None).cast("long").alias("_pos"))
    empty = [F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in anchors.columns if c != "chrom"]
    s = sites.select("chrom", F.col("pos").cast("long").alias("_at")).distinct()
    s = s.select("chrom", *empty, "_at", F.col("_at").alias("_pos"))
    both = a.withColumn("_kind", F.lit(1)).unionByName(s.withColumn("_kind", F.lit(0))).withColumn("_bin", F.floor(F.col("_at") / bin_size))
    order = Window.partitionBy("chrom", "_bin").orderBy(F.col("_at").desc() if forwards else F.col("_at"), "_kind")
    seen = F.last("_pos", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    ends = both.groupBy("chrom", "_bin").agg((F.min("_pos") if forwards else F.max("_pos")).alias("_end"))
    bins = Window.partitionBy("chrom").orderBy(F.col("_bin").desc() if forwards else F.col("_bin"))
    carried = F.last("_end", ignorenulls=True).over(bins.rowsBetween(Window.unboundedPreceding, -1))
    carry = ends.select("chrom", "_bin", carried.alias("_carry"))
    found = both.withColumn("_seen", seen).filter("_kind = 1").join(carry, ["chrom", "_bin"])
    return found.select(*anchors.columns, F.coalesce("_seen", "_carry").alias("_site"))


def nearest_at_distance(
    anchors: DataFrame, sites: DataFrame, minimum: int, maximum: int | None = None, at: str = "pos", name: str = "near", bin_size: int = BIN
) -> DataFrame:
    """``anchors`` (chrom, ``at``, ...) with ``{name}_pos`` and ``{name}_delta``: the nearest of ``sites`` (chrom, pos)
    that is at least ``minimum`` and at most ``maximum`` bases away on either side.

    Deltas are signed; of two equally near sites the right one is taken; null where there is none. Anchors without a contig
    or a position go.
    """
    here = F.col(at).cast("long")
    placed = anchors.filter(F.col("chrom").isNotNull() & here.isNotNull())
    right = _as_of(placed, sites, here + minimum, True, bin_size).withColumnRenamed("_site", "_right")
    both = _as_of(right, sites, here - minimum, False, bin_size).withColumnRenamed("_site", "_left")
    r, left = F.col("_right") - here, here - F.col("_left")
    if maximum is not None:
        r, left = F.when(r <= maximum, r), F.when(left <= maximum, left)
    delta = F.when(left.isNull() | (r <= left), r).otherwise(-left)
    return both.withColumn(f"{name}_delta", delta).withColumn(f"{name}_pos", here + F.col(f"{name}_delta")).drop("_right", "_left")


def nearest_in_list(position: Column, values: Column) -> Column:
    """(pos, delta) of the value nearest to ``position``; of two equally near ones the smaller; null for an empty list."""
    ranked = F.transform(
        values,
        lambda v: F.struct(F.abs(v - position).alias("far"), v.alias("pos"), (v - position).alias("delta")),
    )
    best = F.array_min(ranked)
    return F.when(best.isNotNull(), F.struct(best["pos"].alias("pos"), best["delta"].alias("delta")))

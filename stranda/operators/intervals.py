"""Interval algebra on (chrom, start, end) rows.

Every join carries an equality on contig and bin, so it hashes; every window is partitioned. Merging
works in two steps: islands within a bin first, which shrinks the rows before the contig is seen as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored

#: Bases of the finest bins of range joins; near the length of most intervals is best.
BIN = 4096
#: Each level of bins is this many times as wide as the one below; an interval has at most this many bins, and one for an edge, of its own level.
WIDER = 8
#: Levels of bins: the widest hold any interval of a 64-bit length below 2^42 in a few bins.
LEVELS = 11
#: Bases of a bin within which intervals are merged first.
MERGE_BIN = 1 << 20


def with_islands(df: DataFrame, by: list[str], touching: bool = False) -> DataFrame:
    """``df`` with ``_island``, a number within ``by`` that rows share which overlap (or touch) directly or by way of others."""
    ordered = Window.partitionBy(*by).orderBy("start", "end")
    reached = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.col("start") > reached if touching else F.col("start") >= reached
    return df.withColumn("_new", F.when(reached.isNull() | apart, 1).otherwise(0)).withColumn(
        "_island", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("_new")


def _islands(df: DataFrame, by: list[str], touching: bool) -> DataFrame:
    return with_islands(df, by, touching).groupBy(*by, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def merge_intervals(df: DataFrame, touching: bool = True, bin_size: int = MERGE_BIN) -> DataFrame:
    """Disjoint unions (chrom, start, end) of overlapping intervals, and of touching ones if ``touching``.

    Empty intervals are ignored.
    """
    spans = df.select("chrom", "start", "end").filter("end > start")
    binned = spans.withColumn("_bin", F.floor(F.col("start") / bin_size))
    return _islands(_islands(binned, ["chrom", "_bin"], touching).drop("_bin"), ["chrom"], touching).select("chrom", "start", "end")


def complement(df: DataFrame, lengths: DataFrame) -> DataFrame:
    """Gaps between merged intervals, before the first and after the last, on contigs that have an interval.

    ``lengths`` has (chrom, length).
    """
    merged = merge_intervals(df)
    before = F.lag("end", 1, 0).over(Window.partitionBy("chrom").orderBy("start"))
    gaps = merged.select("chrom", before.alias("start"), F.col("start").alias("end"))
    tails = merged.groupBy("chrom").agg(F.max("end").alias("start")).join(lengths, "chrom")
    return gaps.unionByName(tails.select("chrom", "start", F.col("length").alias("end"))).filter("start < end")


def introns(df: DataFrame, key: str = "transcript_id") -> DataFrame:
    """Positive gaps between neighbouring exons of a transcript in the order of (start, end), with the other columns of the left exon."""
    following = F.lead("start").over(Window.partitionBy(key).orderBy("start", "end"))
    return df.withColumn("_next", following).filter(F.col("_next") > F.col("end")).withColumns(
        {"start": F.col("end"), "end": F.col("_next")}
    ).drop("_next")


def _level(start: Column, end: Column, bin_size: int) -> Column:
    """The finest level of which the interval fills WIDER bins or fewer."""
    length = end - start
    return F.coalesce(*(F.when(length <= bin_size * WIDER ** (k + 1), k) for k in range(LEVELS - 1)), F.lit(LEVELS - 1))


def _width(level: Column, bin_size: int) -> Column:
    return F.element_at(F.array(*(F.lit(bin_size * WIDER**k).cast("long") for k in range(LEVELS))), level + 1)


def _keyed(rows: DataFrame, prefix: str, other: DataFrame, owns_ties: bool, bin_size: int) -> DataFrame:
    """``rows`` once for each key (_wider, _level, _bin) under which they may meet a row of ``other``.

    A pair meets at the wider level of the two. The side that has it gives the bins of its own level, the other side one or
    two bins of each wider level that ``other`` has; on equal levels the side that ``owns_ties`` counts as the wider one.
    """
    own, start, end = F.col(f"_{prefix}_level"), F.col(f"{prefix}_start"), F.col(f"{prefix}_end")
    theirs = "b" if prefix == "a" else "a"
    # at most LEVELS numbers
    levels = other.agg(F.collect_set(f"_{theirs}_level").alias("levels")).scalar()
    above = F.filter("_levels", lambda k: (k >= own) if not owns_ties else (k > own))
    keys = F.concat(
        F.array(F.struct(F.lit(prefix).alias("_wider"), own.alias("_level"))),
        F.transform(above, lambda k: F.struct(F.lit(theirs).alias("_wider"), k.alias("_level"))),
    )
    keyed = rows.withColumn("_levels", levels).withColumn("_key", F.explode(keys)).select(*rows.columns, "_key.*")
    width = _width(F.col("_level"), bin_size)
    return keyed.withColumn("_bin", F.explode(F.sequence(F.floor(start / width), F.floor((end - 1) / width))))


def overlap_pairs(left: DataFrame, right: DataFrame, bin_size: int = BIN) -> DataFrame:
    """Rows of both sides, columns prefixed ``a_`` and ``b_``, for each pair that shares a base.

    Bins come in levels of growing width, and an interval is put into few bins of each, however long it is. A
    pair meets at one level only; where it shares several bins there it is taken in the first.
    """
    a = left.filter("end > start").select(*(F.col(c).alias(f"a_{c}") for c in left.columns))
    b = right.filter("end > start").select(*(F.col(c).alias(f"b_{c}") for c in right.columns))
    a = a.withColumn("_a_level", _level(F.col("a_start"), F.col("a_end"), bin_size))
    b = b.withColumn("_b_level", _level(F.col("b_start"), F.col("b_end"), bin_size))
    x = _keyed(a, "a", b, True, bin_size)
    y = _keyed(b, "b", a, False, bin_size).withColumnsRenamed({"_wider": "_b_wider", "_level": "_at", "_bin": "_b_bin"})
    meet = (F.col("a_chrom") == F.col("b_chrom")) & (F.col("_wider") == F.col("_b_wider")) & (F.col("_level") == F.col("_at"))
    meet = meet & (F.col("_bin") == F.col("_b_bin")) & (F.col("a_start") < F.col("b_end")) & (F.col("b_start") < F.col("a_end"))
    first = F.floor(F.greatest("a_start", "b_start") / _width(F.col("_level"), bin_size))
    found = x.join(y, meet & (F.col("_bin") == first))
    return found.select(*(f"a_{c}" for c in left.columns), *(f"b_{c}" for c in right.columns))


def _overlap_keys(left: DataFrame, right: DataFrame, bin_size: int) -> DataFrame:
    """Distinct spans of ``left`` that overlap ``right``. Merging the right side bounds what a span can meet."""
    spans = left.select("chrom", "start", "end").distinct()
    found = overlap_pairs(spans, merge_intervals(right), bin_size)
    return found.select(F.col("a_chrom").alias("chrom"), F.col("a_start").alias("start"), F.col("a_end").alias("end")).distinct()


def clear_of(rows: DataFrame, key: list[str], disjoint: DataFrame, bin_size: int = BIN) -> DataFrame:
    """Rows of ``rows`` (``key``, chrom, start, end, ...), each of its own key, that share no base with disjoint intervals."""
    hit = overlap_pairs(rows.select(*key, "chrom", "start", "end"), disjoint.select("chrom", "start", "end"), bin_size)
    return rows.join(hit.select(*(F.col(f"a_{k}").alias(k) for k in key)), key, "left_anti")


def overlap_semi(left: DataFrame, right: DataFrame, bin_size: int = BIN) -> DataFrame:
    """Rows of ``left`` that share a base with some interval of ``right``."""
    return left.join(_overlap_keys(left, right, bin_size), ["chrom", "start", "end"], "left_semi")


def overlap_anti(left: DataFrame, right: DataFrame, bin_size: int = BIN) -> DataFrame:
    """Rows of ``left`` that share no base with ``right``."""
    return left.join(_overlap_keys(left, right, bin_size), ["chrom", "start", "end"], "left_anti")


def outside_intervals(sites: DataFrame, intervals: DataFrame, width: int = 3, bin_size: int = BIN) -> DataFrame:
    """Rows of ``sites`` (chrom, pos, ...) whose ``[pos, pos + width)`` lies inside no merged interval."""
    merged = merge_intervals(intervals).filter(F.col("end") - F.col("start") >= width)
    inside = stored(merged.withColumn("_level", _level(F.col("start"), F.col("end"), bin_size)), "inside")
    # a site has one bin of a level, so sites are read once and joined as they are, once for each level there is
    for level in sorted(r[0] for r in inside.select("_level").distinct().collect()):
        size = F.lit(bin_size * WIDER**level).cast("long")
        bins = F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size)))
        held = inside.filter(F.col("_level") == level).select(F.col("chrom").alias("_in_chrom"), F.col("start").alias("_in_start"), F.col("end").alias("_in_end"), bins.alias("_in_bin"))
        same = (F.col("chrom") == F.col("_in_chrom")) & (F.floor(F.col("pos") / size) == F.col("_in_bin"))
        within = (F.col("pos") >= F.col("_in_start")) & (F.col("pos") + width <= F.col("_in_end"))
        sites = sites.join(held, same & within, "left_anti")
    return sites


def sorted_intervals(intervals: Column, descending: Column | None = None) -> Column:
    """An array of intervals by (start, end), descending where asked."""
    up = F.sort_array(intervals)
    return up if descending is None else F.when(descending, F.sort_array(intervals, asc=False)).otherwise(up)

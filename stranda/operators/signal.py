"""Score statistics over spans, from interval records of a track (chrom, start, end, value).

A record counts with as many bases as it shares with the span; bases without a record count as 0. Statistics in double come from
running sums of the track; the exact form, and ``signal_lookup``, cost as many rows as a span meets records.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import STATISTICS
from .intervals import BIN, overlap_pairs

#: Bases of a bin of running sums: a lookup sorts the records of one such bin.
SUM_BIN = 1024


def round_score(value: Column) -> Column:
    """Two decimals, halves to the even digit of the hundredfold value."""
    return F.rint(value.cast("double") * 100) / 100


def hundredths(value: Column) -> Column:
    """``round_score`` as a whole number of hundredths, of which sums are exact in any order."""
    return F.rint(value.cast("double") * 100).cast("long")


def statistics_of_sums(n: Column, s: Column, ss: Column, n_pos: Column, n_neg: Column, s_pos: Column, s_neg: Column) -> dict[str, Column]:
    """The six statistics of ``n`` bases (null where none counts) from whole numbers: the sums of hundredths, of their squares, and of
    positive and negative ones. The spread is exact up to its last division and root."""
    long, double = (lambda c: c.cast("decimal(20,0)")), (lambda c: c.cast("double"))
    over = lambda total, count: F.when(count > 0, double(total) / 100 / F.when(count > 0, double(count))).otherwise(F.lit(0.0))
    spread = F.sqrt(double(F.greatest(long(n) * long(ss) - long(s) * long(s), F.lit(0)))) / double(n) / 100
    values = (double(s) / 100 / double(n), spread, double(n_pos) / double(n), double(n_neg) / double(n), over(s_pos, n_pos), over(s_neg, n_neg))
    return dict(zip(STATISTICS, values, strict=True))


def signal_lookup(spans: DataFrame, track: DataFrame, bin_size: int = BIN) -> DataFrame:
    """(span_id, at, bases, value): what each of ``spans`` (span_id, chrom, start, end) shares with the track's records."""
    met = overlap_pairs(spans.select("span_id", "chrom", "start", "end"), track.select("chrom", "start", "end", "value"), bin_size)
    low, high = F.greatest("a_start", "b_start"), F.least("a_end", "b_end")
    return met.select(
        F.col("a_span_id").alias("span_id"), (low - F.col("a_start")).alias("at"), (high - low).alias("bases"),
        round_score(F.col("b_value")).alias("value"),
    )


def _per_base(value: Column) -> dict[str, Column]:
    """What a base with this score adds to each sum, in whole hundredths; one without a finite score only to ``odd``."""
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value.cast("double")) < float("inf"))
    x = F.when(finite, hundredths(value)).otherwise(F.lit(0).cast("long"))
    one = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("long")
    zero = F.lit(0).cast("long")
    return {"odd": one(~finite), "s": x, "ss": x * x, "np": one(x > 0), "nn": one(x < 0), "sp": F.greatest(x, zero), "sn": F.least(x, zero)}


SUMS = ("odd", "s", "ss", "np", "nn", "sp", "sn")


def running_sums(points: DataFrame, track: DataFrame, bin_size: int = SUM_BIN) -> DataFrame:
    """``points`` (chrom, pos, ...) with SUMS: the sums over all bases of the contig before ``pos``, exact whole numbers.

    Two parts make them up. Sums over whole bins come from one row for each bin of the track, added up along the contig.
    What lies before the point in its own bin comes from a pass over the starts and ends of the records of that bin: between them
    a sum grows by a fixed amount a base, so the changes up to a point give its value. Only records of bins with a point are sorted.
    """
    records = track.select("chrom", F.col("start").cast("long").alias("s0"), F.col("end").cast("long").alias("e0"), "value").filter("e0 > s0")
    bins = F.sequence(F.floor(F.col("s0") / bin_size), F.floor((F.col("e0") - 1) / bin_size))
    cut = records.withColumn("_bin", F.explode(bins)).select(
        "chrom", "_bin", F.greatest(F.col("s0") - F.col("_bin") * bin_size, F.lit(0)).alias("low"), F.least(F.col("e0") - F.col("_bin") * bin_size, F.lit(bin_size)).alias("high"),
        *(c.alias(k) for k, c in _per_base(F.col("value")).items()),
    )
    placed = points.withColumn("_bin", F.floor(F.col("pos") / bin_size))
    size = F.col("high") - F.col("low")
    whole = cut.groupBy("chrom", "_bin").agg(*(F.sum(F.col(k) * size).alias(k) for k in SUMS))
    asked = placed.select("chrom", "_bin").distinct()
    # a row for each bin that has records or points
    every = whole.unionByName(asked, allowMissingColumns=True).groupBy("chrom", "_bin").agg(*(F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in SUMS))
    before = Window.partitionBy("chrom").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("chrom", "_bin", *(F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"c_{k}") for k in SUMS))
    own = cut.join(asked, ["chrom", "_bin"], "left_semi")
    sides = F.explode(F.array(F.struct(F.col("low").alias("at"), F.lit(1).alias("sign")), F.struct(F.col("high").alias("at"), F.lit(-1).alias("sign"))))
    changes = own.select("chrom", "_bin", sides.alias("x"), *SUMS).select("chrom", "_bin", F.col("x.at").alias("at"), *((F.col(k) * F.col("x.sign")).alias(k) for k in SUMS))
    rows = placed.select(F.struct("*").alias("row"), "chrom", "_bin", (F.col("pos") - F.col("_bin") * bin_size).alias("at"))
    both = rows.unionByName(changes, allowMissingColumns=True)
    so_far = Window.partitionBy("chrom", "_bin").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    level = lambda k: F.coalesce(F.sum(k).over(so_far), F.lit(0))
    paid = lambda k: F.coalesce(F.sum(F.col(k) * F.col("at")).over(so_far), F.lit(0))
    inside = both.select("row", "chrom", "_bin", *((F.col("at") * level(k) - paid(k)).alias(k) for k in SUMS)).filter("row is not null")
    joined = inside.join(carried, ["chrom", "_bin"])
    return joined.select("row.*", *((F.col(k) + F.col(f"c_{k}")).alias(k) for k in SUMS)).drop("_bin")


def score_stats(spans: DataFrame, track: DataFrame, prefix: str = "", bin_size: int = SUM_BIN) -> DataFrame:
    """(span_id, mean, std, frac_pos, frac_neg, mean_pos, mean_neg) of ``spans`` (span_id, chrom, start, end), in double.

    A span costs two lookups in the track's running sums, however long it is. Scores count with two decimals. Population
    standard deviation; means of positive and negative bases are 0 where there are none; records without a finite value are
    left out; a span that is empty or has no other records and bases gives NaN throughout. Records that overlap add up.
    """
    ends = F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(-1).alias("sign")), F.struct(F.col("end").alias("pos"), F.lit(1).alias("sign"))))
    points = spans.filter("end > start").select("span_id", "chrom", ends.alias("x")).select("span_id", "chrom", F.col("x.pos").cast("long").alias("pos"), "x.sign")
    found = running_sums(points, track, bin_size).groupBy("span_id").agg(*(F.sum(F.col(k) * F.col("sign")).alias(k) for k in SUMS))
    sized = spans.select("span_id", (F.col("end") - F.col("start")).cast("long").alias("size")).join(found, "span_id", "left")
    c = {k: F.coalesce(k, F.lit(0)) for k in SUMS}
    n = F.greatest(F.col("size"), F.lit(0)) - c["odd"]
    n = F.when(n > 0, n)  # null where nothing counts, so nothing is divided by 0
    values = statistics_of_sums(n, *(c[k] for k in SUMS[1:]))
    nan = F.lit(float("nan"))
    return sized.select("span_id", *(F.when(n.isNotNull(), v).otherwise(nan).alias(f"{prefix}{k}") for k, v in values.items()))


def exact_stats(scores: np.ndarray) -> np.ndarray:
    """The six statistics of one array in single precision, in NumPy's own order of summation."""
    scores = np.asarray(scores, np.float32)
    good = scores[~np.isnan(scores)]
    if not len(good):
        return np.full(6, np.nan, np.float32)
    up, down = good[good > 0], good[good < 0]
    side = lambda x: x.mean() if len(x) else 0.0
    spread = np.nanstd(scores)
    return np.array([np.nanmean(scores), spread, len(up) / len(good), len(down) / len(good), side(up), side(down)], np.float32)


def exact_score_stats(spans: DataFrame, track: DataFrame, prefix: str = "", bin_size: int = BIN) -> DataFrame:
    """As ``score_stats``, in single precision and in the base order of the strand (``spans`` has strand), bit for bit."""
    met = signal_lookup(spans, track, bin_size)
    gathered = met.groupBy("span_id").agg(F.collect_list(F.struct("at", "bases", "value")).alias("records"))  # one span's records
    rows = spans.select("span_id", "strand", (F.col("end") - F.col("start")).alias("size")).join(gathered, "span_id", "left")
    schema = "span_id " + spans.schema["span_id"].dataType.simpleString() + "".join(f", {prefix}{k} float" for k in STATISTICS)

    def compute(batches):
        for pdf in batches:
            out = []
            for strand, size, records in zip(pdf["strand"], pdf["size"], pdf["records"], strict=True):
                dense = np.zeros(max(0, int(size)), np.float32)
                for r in records if records is not None else ():
                    dense[r["at"] : r["at"] + r["bases"]] = r["value"]
                out.append(exact_stats(dense[::-1] if strand == "-" else dense))
            yield pd.DataFrame(np.array(out, np.float32).reshape(-1, 6), columns=[f"{prefix}{k}" for k in STATISTICS]).assign(
                span_id=pdf["span_id"].to_numpy()
            )[["span_id", *(f"{prefix}{k}" for k in STATISTICS)]]

    return rows.mapInPandas(compute, schema)

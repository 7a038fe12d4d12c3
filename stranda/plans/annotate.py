"""Score statistics of dataset rows at two spans: the region's own and its symmetric context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import baseline_roi_span, context_bounds
from ..operators.signal import exact_score_stats, score_stats
from ..schemas import SCORE_PREFIXES, SCORES, STATISTICS
from ..sources.writers import publish, standing


def span_table(dataset: DataFrame, lengths: DataFrame) -> DataFrame:
    """Distinct spans of a dataset's rows (chrom, start, end, strand), both kinds.

    The same region occurs in several files, controls and policies; its statistics are computed once.
    """
    col = F.col
    sized = dataset.join(F.broadcast(lengths.withColumnRenamed("length", "_length")), "chrom", "left")
    known = F.when(
        col("_length").isNull(), F.raise_error(F.concat(F.lit("the score track lacks contig "), col("chrom"))).cast("long")
    ).otherwise(col("_length"))
    sized = sized.withColumn("_length", known)
    roi = baseline_roi_span(
        col("scope"), col("_length"), col("start"), col("end"), col("strand"), col("context_start"), col("context_end"), col("pool_start"), col("pool_end")
    )
    around = context_bounds(col("_length"), col("start"), col("end"), col("strand"), policy="symmetric")
    return sized.withColumns({"_roi_start": roi[0], "_roi_end": roi[1], "_ctx_start": around[0], "_ctx_end": around[1]}).drop("_length")


def annotate(dataset: DataFrame, track: DataFrame, lengths: DataFrame, exact: bool = False) -> DataFrame:
    """``dataset`` with the twelve statistics columns.

    ``lengths`` (chrom, length) are the track's contigs; a row of another contig raises, as does a dataset that has
    statistics. ``exact`` gives single-precision values bit for bit as published.
    """
    if have := [c for c in SCORES.names if c in dataset.columns]:
        raise ValueError(f"the dataset already has {', '.join(have)}")
    framed = span_table(dataset, lengths)
    keys = {"phylop": ("_roi_start", "_roi_end"), "phylop_context": ("_ctx_start", "_ctx_end")}
    by_strand = F.when(F.col("strand") == "-", "-").otherwise("+")
    parts = [
        framed.select("chrom", F.col(s).alias("start"), F.col(e).alias("end"), by_strand.alias("strand")) for s, e in keys.values()
    ]
    spans = parts[0].unionByName(parts[1]).distinct()
    stats = exact_score_stats(_keyed(spans), track) if exact else score_stats(_keyed(spans), track)
    out = framed
    for prefix in SCORE_PREFIXES:
        start, end = keys[prefix]
        own = stats.select("span_id", *(F.col(k).cast("float").alias(f"{prefix}_{k}") for k in STATISTICS))
        key = F.concat_ws("|", "chrom", F.col(start).cast("string"), F.col(end).cast("string"), by_strand)
        out = out.withColumn("_span", key).join(own, F.col("_span") == F.col("span_id"), "left").drop("_span", "span_id")
    return out.select(*dataset.columns, *SCORES.names)


def _keyed(spans: DataFrame) -> DataFrame:
    key = F.concat_ws("|", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "strand")
    return spans.withColumn("span_id", key)


def annotate_in_place(spark: SparkSession, path: str, track: DataFrame, lengths: DataFrame, exact: bool = False) -> DataFrame:
    """Replace a Parquet dataset by itself with statistics."""
    return publish(annotate(spark.read.parquet(standing(spark, path)), track, lengths, exact), path)

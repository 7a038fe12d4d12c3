"""FASTA files as tiles of their contigs, without a row that holds a contig.

Lines are numbered within the file split they come from, and a split is taken in runs of ``RUN`` lines. Running sums of bases
within a run, and one small row for each run that carries the open record and its bases on to the next one, give every
line its record and its offset there. No task has to sort a split. A tile is then made of the lines that reach into it. All
steps are linear in the size of the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.windows import OVERLAP, TILE

#: Longest piece of a line that is one row; only unwrapped sequences have longer lines.
PIECE = 1 << 16
#: Lines, as a power of two, that are summed up in one place.
RUN = 13


def fasta_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source, block, line_no, piece, name, bases, n): pieces of lines in the order of their file split.

    A header has a name, its first word after ``>`` (which may be empty), and no bases; a sequence line has no name and its
    bases as bytes, without white space. A ``>`` that does not begin a line means nothing.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
    )
    header = F.col("line").startswith(">")
    name = F.when(header, F.regexp_extract("line", r"^>(\S*)", 1))
    bases = F.when(header, "").otherwise(F.regexp_replace("line", r"\s+", "")).cast("binary")
    whole = lines.select("source", "block", "line_no", name.alias("name"), bases.alias("_all"))
    last = F.greatest(F.floor((F.octet_length("_all") - 1) / PIECE), F.lit(0))
    cut = whole.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    cut = cut.withColumn("bases", F.substring("_all", (F.col("piece") * PIECE + 1).cast("int"), F.lit(PIECE))).drop("_all")
    return cut.withColumn("n", F.octet_length("bases").cast("long")).filter("n > 0 or name is not null")


def line_index(lines: DataFrame) -> DataFrame:
    """(chrom, at, n, bases, header) of ``fasta_lines``: the record of each piece and its offset there. What no header precedes goes."""
    lines = lines.withColumn("run", F.shiftright("line_no", RUN))
    split = ["source", "block", "run"]
    order = Window.partitionBy(*split).orderBy("line_no", "piece")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    header = F.col("name").isNotNull()
    placed = lines.withColumns({"seg": F.sum(header.cast("long")).over(so_far), "_name": F.last("name", ignorenulls=True).over(so_far)})
    before = Window.partitionBy(*split, "seg").orderBy("line_no", "piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_at", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # from here a row for each run of a file: what the records that are open at its end have so far
    segments = placed.groupBy(*split, "seg").agg(F.sum("n").alias("n"), F.max("_name").alias("name"))
    splits = segments.groupBy(*split).agg(F.max("seg").alias("heads"), F.max_by("n", "seg").alias("tail"), F.max_by("name", "seg").alias("name"))
    in_file = Window.partitionBy("source").orderBy("block", "run")
    splits = splits.withColumn("_open", F.sum((F.col("heads") > 0).cast("long")).over(in_file))
    reach = F.sum("tail").over(Window.partitionBy("source", "_open").orderBy("block", "run"))
    named = F.last("name", ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, 0))
    splits = splits.withColumns({"_reach": reach, "_named": named})
    carried = splits.select(*split, F.lag("_reach").over(in_file).alias("_carry"), F.lag("_named").over(in_file).alias("_open_name"))
    joined = placed.join(carried, split)
    chrom = F.when(F.col("seg") > 0, F.col("_name")).otherwise(F.col("_open_name"))
    at = F.col("_at") + F.when(F.col("seg") > 0, F.lit(0)).otherwise(F.coalesce("_carry", F.lit(0)))
    return joined.select(chrom.alias("chrom"), at.cast("long").alias("at"), "n", "bases", header.alias("header")).filter("chrom <> ''")


def scan_fasta(spark: SparkSession, path: str | list[str], tile: int = TILE, overlap: int = OVERLAP) -> DataFrame:
    """(chrom, tile, tile_start, length, seq): the tiles that ``tile_genome`` cuts, from the lines of FASTA files.

    A record without bases has one empty tile. Records without a name go; a name that two records have raises.
    """
    index = line_index(fasta_lines(spark, path))
    once = F.when(F.count_if("header") > 1, F.raise_error(F.concat(F.lit("a contig is given twice: "), F.first("chrom")))).otherwise(F.max(F.col("at") + F.col("n")))
    lengths = index.groupBy("chrom").agg(once.cast("long").alias("length"))
    first = F.greatest(F.floor((F.col("at") - overlap) / tile), F.lit(0))
    last = F.greatest(F.floor((F.col("at") + F.col("n") - 1) / tile), first)
    low = F.greatest(F.col("at"), F.col("tile") * tile)
    high = F.least(F.col("at") + F.col("n"), F.col("tile") * tile + tile + overlap)
    reaching = index.withColumn("tile", F.explode(F.sequence(first, last))).select(
        "chrom", "tile", low.alias("low"), F.substring("bases", (low - F.col("at") + 1).cast("int"), (high - low).cast("int")).cast("string").alias("text")
    )
    # a tile has as many pieces as lines reach into it
    pieces = reaching.groupBy("chrom", "tile").agg(F.array_sort(F.collect_list(F.struct("low", "text"))).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    return pieces.join(lengths, "chrom").select("chrom", "tile", (F.col("tile") * tile).alias("tile_start"), "length", text.alias("seq"))

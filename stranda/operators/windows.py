"""Strand-oriented sequence windows around regions, from a tiled genome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import assign_split, context_bounds, ordered_bounds, roi_offsets
from ..functions.sequence import motif_positions, reverse_complement, slice_of
from ..schemas import CONTEXT_LENGTH, DATASET, conform

#: Bases of a tile and what it repeats of the next one.
TILE, OVERLAP = 1 << 16, CONTEXT_LENGTH - 1


def tile_genome(genome: DataFrame, tile: int = TILE, overlap: int = OVERLAP) -> DataFrame:
    """(chrom, tile, tile_start, length, seq) of a genome (chrom, seq).

    Windows of at most ``overlap + 1`` bases lie inside the tile of their first base, so a contig of any length is
    read in pieces of bounded size. Tiles are cut from bytes, which takes time in proportion to the tile wherever it
    lies; only a text with letters of several bytes is cut by letters.
    """
    sized = genome.select("chrom", "seq", F.char_length("seq").cast("long").alias("length"), F.col("seq").cast("binary").alias("_bytes"))
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((F.col("length") - 1) / tile), F.lit(0)))
    first, size = lambda t: (t * tile + 1).cast("int"), F.lit(tile + overlap)
    piece = lambda t, text: F.struct(t.alias("tile"), text.alias("seq"))
    # all tiles are cut before rows are made of them, so that no row of a tile carries the contig
    plain = F.transform(starts, lambda t: piece(t, F.substring("_bytes", first(t), size).cast("string")))
    wide = F.transform(starts, lambda t: piece(t, F.substr("seq", first(t), size)))
    cut = sized.select("chrom", "length", F.explode(F.when(F.octet_length("_bytes") == F.col("length"), plain).otherwise(wide)).alias("t"))
    return cut.select("chrom", "t.tile", (F.col("t.tile") * tile).alias("tile_start"), "length", "t.seq")


def contig_lengths(tiles: DataFrame) -> DataFrame:
    return tiles.filter("tile = 0").select("chrom", "length")


def genome_lookup(rows: DataFrame, tiles: DataFrame, start: str, end: str, tile: int = TILE) -> DataFrame:
    """``rows`` (chrom, ...) with ``sequence``: the bases ``[start, end)``, by an equi-join on contig and tile."""
    keyed = rows.withColumn("tile", F.floor(F.col(start) / tile))
    joined = keyed.join(tiles.select("chrom", "tile", "tile_start", "seq"), ["chrom", "tile"])
    piece = slice_of(F.col("seq"), F.col(start) - F.col("tile_start"), F.col(end) - F.col("tile_start"))
    return joined.withColumn("sequence", piece).drop("tile", "tile_start", "seq")


def context_windows(
    regions: DataFrame, tiles: DataFrame, policy: str = "causal", length: int = CONTEXT_LENGTH, tile: int = TILE
) -> DataFrame:
    """``regions`` (chrom, start, end, strand, ...) with their context: sequence, context_start, context_end,
    roi_start, roi_end, context_policy.

    Regions that are empty, lie on an unknown contig or have no base in their window go. Sequences are upper case
    and reverse-complemented on ``-``; the region's offsets follow.
    """
    if length > OVERLAP + 1:
        raise ValueError(f"windows of more than {OVERLAP + 1} bases need tiles with a larger overlap")
    low, high = ordered_bounds(F.col("start"), F.col("end"))
    located = regions.withColumns({"_low": low, "_high": high}).filter("_high > _low").join(contig_lengths(tiles), "chrom")
    first, last = context_bounds(F.col("length"), F.col("_low"), F.col("_high"), F.col("strand"), length, policy)
    framed = located.withColumns({"context_start": first, "context_end": last}).filter("context_end > context_start")
    found = genome_lookup(framed, tiles, "context_start", "context_end", tile)
    roi = roi_offsets(F.col("_low"), F.col("_high"), F.col("strand"), F.col("context_start"), F.char_length("sequence"))
    turned = F.when(F.col("strand") == "-", reverse_complement(F.upper("sequence"))).otherwise(F.upper("sequence"))
    return (
        found.withColumns({"roi_start": roi[0], "roi_end": roi[1], "sequence": turned, "context_policy": F.lit(policy)})
        .filter("roi_end > roi_start")
        .drop("_low", "_high", "length")
    )


def dataset_rows(windows: DataFrame, label: Column, scope: Column, pool: tuple[Column, Column] | None = None) -> DataFrame:
    """Windows as rows of the fixed schema; the pool is the region unless given."""
    pool = pool or (F.col("roi_start"), F.col("roi_end"))
    return conform(
        windows.withColumns(
            {
                "split": assign_split(F.col("chrom")), "label": label, "scope": scope, "pair_id": F.col("pair_id").cast("string"),
                "pool_start": pool[0].cast("int"), "pool_end": pool[1].cast("int"),
            }
        ),
        DATASET,
    )


def motif_scan(tiles: DataFrame, motif: str = "ATG", tile: int = TILE) -> DataFrame:
    """(chrom, pos) of every occurrence of a motif, found in the tile of its first base."""
    own = F.upper(F.substr("seq", F.lit(1), F.lit(tile + len(motif) - 1)))
    return tiles.select("chrom", "tile_start", F.explode(motif_positions(own, motif)).alias("at")).select(
        "chrom", (F.col("tile_start") + F.col("at")).alias("pos")
    )

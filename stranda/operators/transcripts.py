"""Transcripts: annotation lines to features, coding blocks, and the start codons they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.attributes import attribute_values, has_tag
from ..functions.geometry import upstream_tss
from ..functions.sequence import blocks_length, genomic_position, motif_positions, reverse_complement, slice_of, trimmed_blocks
from ..schemas import FLANK_DISTANCE
from .intervals import merge_intervals
from .windows import TILE

CANONICAL_TAGS = ("Ensembl_canonical", "CCDS")
SELECT_TAG = "MANE_Select"


def annotated_lines(gtf: DataFrame) -> DataFrame:
    """Lines of an annotation (source, line_no, chrom, kind, start, end, strand, phase, attrs) with transcript_id, gene_id and transcript_type."""
    return gtf.withColumn("_a", attribute_values(F.col("attrs"), "transcript_id", "gene_id", "transcript_type")).select("*", "_a.*").drop("_a")


def _last_known(lines: DataFrame) -> DataFrame:
    """(source, transcript_id, t, first_line) of transcript lines with an id, a gene and a type; a later line of the same id takes the earlier one's place, parts and all."""
    whole = lines.filter("kind = 'transcript' and transcript_id <> '' and gene_id <> '' and transcript_type <> ''")
    canonical = has_tag(F.col("attrs"), *CANONICAL_TAGS).alias("canonical")
    return whole.groupBy("source", "transcript_id").agg(
        F.max_by(F.struct("chrom", "start", "end", "strand", "transcript_type", canonical, "line_no"), "line_no").alias("t"),
        F.min("line_no").alias("first_line"),
    )


def _last_canonical(lines: DataFrame) -> DataFrame:
    return _last_known(lines).filter("t.canonical")


def _with_transcript(lines: DataFrame, last: DataFrame) -> DataFrame:
    """``lines`` that come after the line of their transcript in ``last``, or are that line, as (source, transcript_id, t, first_line, kind, line_no, p_start, p_end)."""
    own = lines.select("source", "transcript_id", "kind", "line_no", F.col("start").alias("p_start"), F.col("end").alias("p_end"))
    return own.join(last, ["source", "transcript_id"]).filter(F.col("line_no") >= F.col("t.line_no"))


def _coding() -> Column:
    """Whether a part gives a coding region: the CDS of transcripts of this type only."""
    return (F.col("kind") == "CDS") & (F.col("transcript_type") == "protein_coding")


def feature_lines(gtf: DataFrame) -> DataFrame:
    """(source, line_no, transcript_id, chrom, strand, kind, start, end, coding) of the lines of an annotation that count.

    A transcript needs an id, a gene and a type; exons and CDS need such a transcript before them in the same file, whatever else they
    name themselves. Contig and strand are the transcript's, as is the type that ``coding`` looks at.
    """
    lines = annotated_lines(gtf)
    kept = _with_transcript(lines.filter("kind in ('transcript', 'exon', 'CDS')"), _last_known(lines))
    kept = kept.filter((F.col("kind") != "transcript") | (F.col("line_no") == F.col("t.line_no"))).withColumn("transcript_type", F.col("t.transcript_type"))
    return kept.select(
        "source", "line_no", "transcript_id", F.col("t.chrom").alias("chrom"), F.col("t.strand").alias("strand"), "kind",
        F.col("p_start").alias("start"), F.col("p_end").alias("end"), _coding().alias("coding"),
    )


def canonical_parts(gtf: DataFrame) -> DataFrame:
    """Exons and CDS of canonical transcripts, with the transcript's own span, strand, type and place in the file.

    A part belongs to the last transcript line of its id before it in the same file; parts before any are left out.
    """
    lines = annotated_lines(gtf)
    joined = _with_transcript(lines.filter("kind in ('exon', 'CDS')"), _last_canonical(lines))
    return joined.select(
        "source", "transcript_id", F.col("t.chrom").alias("chrom"), F.col("t.start").alias("t_start"), F.col("t.end").alias("t_end"), F.col("t.strand").alias("strand"),
        F.col("t.transcript_type").alias("transcript_type"), "first_line", "kind", "line_no", F.col("p_start").alias("start"), F.col("p_end").alias("end"),
    )


def canonical_transcripts(gtf: DataFrame) -> DataFrame:
    return _last_canonical(annotated_lines(gtf)).select("source", "transcript_id", "first_line", "t.chrom", "t.start", "t.end", "t.strand")


def gene_features(gtf: DataFrame) -> DataFrame:
    """(chrom, start, end, name, score, strand, category, source, first_line, part) of coding regions, exons, introns and upstream flanks."""
    # parts are read and joined once, and each gives all its features
    following = F.lead("start").over(Window.partitionBy("source", "transcript_id", "kind").orderBy("start", "end"))
    parts = canonical_parts(gtf).withColumn("_next", following)
    low, high = upstream_tss(F.col("start"), F.col("end"), F.col("strand"), FLANK_DISTANCE)
    flanks = canonical_transcripts(gtf).withColumns({"_s": low, "_e": high}).filter("_e > _s")

    def feature(category: str, start: str, end: str, part: Column) -> Column:
        long = lambda c: c.cast("long")
        return F.struct(long(F.col(start)).alias("start"), long(F.col(end)).alias("end"), F.lit(category).alias("category"), long(part).alias("part"))

    def rows(df: DataFrame, made: Column) -> DataFrame:
        return df.withColumn("_f", made).select(
            "chrom", "_f.start", "_f.end", F.col("transcript_id").alias("name"), F.lit(0.0).alias("score"), "strand", "_f.category", "source", "first_line", "_f.part"
        )

    exon = F.col("kind") == "exon"
    made = F.array(
        F.when(_coding(), feature("coding_regions", "start", "end", F.col("line_no"))),
        F.when(exon, feature("exons", "start", "end", F.col("line_no"))),
        F.when(exon & (F.col("_next") > F.col("end")), feature("introns", "end", "_next", F.col("end"))),
    )
    return rows(parts, F.explode(F.array_compact(made))).unionByName(rows(flanks, feature("upstream_TSS", "_s", "_e", F.lit(0))))


def annotated_spans(gtf: DataFrame) -> DataFrame:
    """(chrom, start, end) of all parts of canonical transcripts."""
    return canonical_parts(gtf).select("chrom", "start", "end")


def coding_transcripts(gtf: DataFrame) -> DataFrame:
    """(chrom, transcript_id, gene_id, strand, blocks, line_no) of selected transcripts with at least three coding bases."""
    lines = annotated_lines(gtf).filter(F.col("kind") == "CDS").filter(F.col("strand").isin("+", "-"))
    lines = lines.filter(has_tag(F.col("attrs"), SELECT_TAG) & (F.col("transcript_id") != "") & (F.col("gene_id") != ""))
    phase = F.coalesce(F.col("phase").try_cast("int"), F.lit(0))
    grouped = lines.groupBy("chrom", "transcript_id").agg(
        F.min_by("gene_id", "line_no").alias("gene_id"), F.min_by("strand", "line_no").alias("strand"), F.min("line_no").alias("line_no"),
        F.collect_list(F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), phase.alias("phase"))).alias("cds"),
    )
    blocks = trimmed_blocks(F.col("cds"), F.col("strand"))
    return grouped.withColumn("blocks", blocks).drop("cds").filter(blocks_length(F.col("blocks")) >= 3)


def coding_spans(transcripts: DataFrame) -> DataFrame:
    """Merged (chrom, start, end) of all blocks."""
    spans = transcripts.select("chrom", F.explode("blocks").alias("b")).select("chrom", "b.start", "b.end")
    return merge_intervals(spans)


def spliced_transcripts(transcripts: DataFrame, tiles: DataFrame, compat: bool = True, tile: int = TILE) -> DataFrame:
    """(chrom, transcript_id, spliced): the bases of the blocks on the strand, in upper case, stitched from a tiled genome.

    Blocks are cut at tile edges and each piece is looked up by contig and tile, so no row is longer than a tile or a
    transcript. ``compat`` and without it: the two orders of ``spliced_sequence``. (chrom, transcript_id) is unique in ``transcripts``.
    What lies beyond the contig has no bases; a transcript none of whose blocks meets a tile goes.
    """
    block = transcripts.select("chrom", "transcript_id", "strand", F.posexplode("blocks").alias("place", "b")).filter("b.end > b.start")
    within = F.sequence(F.floor(F.col("b.start") / tile), F.floor((F.col("b.end") - 1) / tile))
    pieces = block.withColumn("tile", F.explode(within)).select(
        "chrom", "transcript_id", "strand", "place", "tile", F.greatest("b.start", F.col("tile") * tile).alias("low"), F.least("b.end", (F.col("tile") + 1) * tile).alias("high")
    )
    found = pieces.join(tiles.select("chrom", "tile", "tile_start", "seq"), ["chrom", "tile"])
    text = F.upper(slice_of(F.col("seq"), F.col("low") - F.col("tile_start"), F.col("high") - F.col("tile_start")))
    # complementing block by block on - is complementing the blocks joined the other way round
    order = F.col("place") if compat else F.when(F.col("strand") == "-", -F.col("place")).otherwise(F.col("place"))
    stitched = found.select("chrom", "transcript_id", "strand", F.struct(order.alias("place"), "low", text.alias("text")).alias("piece"))
    grouped = stitched.groupBy("chrom", "transcript_id").agg(F.first("strand").alias("strand"), F.array_sort(F.collect_list("piece")).alias("pieces"))
    plain = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    return grouped.withColumn("spliced", plain).select(
        "chrom", "transcript_id", F.when(F.col("strand") == "-", reverse_complement(F.col("spliced"))).otherwise(F.col("spliced")).alias("spliced")
    )


def codon_sites(transcripts: DataFrame, tiles: DataFrame, compat: bool = True, tile: int = TILE) -> DataFrame:
    """``transcripts`` whose spliced sequence starts with ATG, with ``spliced``, ``anchor`` and the ascending genome positions of
    further ATGs in and out of frame. ``tiles`` is the tiled genome."""
    spliced = spliced_transcripts(transcripts, tiles, compat, tile).filter(F.col("spliced").startswith("ATG"))
    coding = transcripts.join(spliced, ["chrom", "transcript_id"]).withColumn("_at", motif_positions(F.col("spliced")))
    place = lambda o: genomic_position(F.col("blocks"), o, F.col("strand"))
    some = lambda keep: F.array_sort(F.filter(F.transform(F.filter("_at", keep), place), lambda p: p.isNotNull()))
    return coding.withColumns(
        {
            "anchor": place(F.lit(0).cast("long")),
            "inframe": some(lambda o: (o > 0) & (F.pmod(o, F.lit(3)) == 0)),
            "outframe": some(lambda o: F.pmod(o, F.lit(3)) != 0),
        }
    ).drop("_at").filter("anchor is not null")

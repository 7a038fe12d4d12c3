"""Interval and window geometry as column expressions. Coordinates are 0-based and half-open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CONTEXT_LENGTH, KEPT_OF_LONG, POLICIES, TEST_CONTIGS

#: Names of the mitochondrial contig that are taken for each other. A fixed value.
MITOCHONDRIAL = ("M", "MT", "chrM", "chrMT")


def normalize_contig(chrom: Column, known: list[str]) -> Column:
    """The name under which a genome has a contig: as it is, with or without ``chr``, or another mitochondrial name."""
    names = F.array(*map(F.lit, known)) if known else F.expr("cast(array() as array<string>)")
    toggled = F.when(chrom.startswith("chr"), F.substr(chrom, F.lit(4))).otherwise(F.concat(F.lit("chr"), chrom))
    mito = next((m for m in ("chrM", "MT", "M") if m in known), None)
    out = F.when(F.array_contains(names, chrom), chrom).when(F.array_contains(names, toggled), toggled)
    if mito is not None:
        out = out.when(chrom.isin(*MITOCHONDRIAL), F.lit(mito))
    return out.otherwise(chrom)


def ordered_bounds(a: Column, b: Column) -> tuple[Column, Column]:
    return F.least(a, b), F.greatest(a, b)


def context_bounds(
    chrom_length: Column, start: Column, end: Column, strand: Column, length: int = CONTEXT_LENGTH, policy: str = "causal"
) -> tuple[Column, Column]:
    """Start and end of the window that gives a region its context.

    ``causal``: the window ends with the region on ``+`` and starts with it on any other strand; of a region longer
    than the window only its last (first) bases are kept. ``symmetric``: the window is centred on the region and
    moved inwards at contig ends.
    """
    start, end = ordered_bounds(start, end)
    if policy == "causal":
        width = F.when(end - start > length, F.lit(min(KEPT_OF_LONG, length))).otherwise(F.lit(length))
        plus = strand == "+"
        return (
            F.when(plus, F.greatest(F.lit(0), end - width)).otherwise(start).cast("long"),
            F.when(plus, end).otherwise(F.least(chrom_length, start + width)).cast("long"),
        )
    if policy == "symmetric":
        first = F.greatest(F.lit(0), F.floor((start + end) / 2) - length // 2)
        last = F.least(chrom_length, first + length)
        return F.greatest(F.lit(0), last - length).cast("long"), last.cast("long")
    raise ValueError(f"unknown context policy {policy!r}; known are {', '.join(POLICIES)}")


def mirrored(start: Column, end: Column, size: Column) -> tuple[Column, Column]:
    """Offsets of the same span counted from the other end."""
    return size - end, size - start


def roi_offsets(start: Column, end: Column, strand: Column, context_start: Column, size: Column) -> tuple[Column, Column]:
    """The region's offsets in its oriented window of ``size`` bases."""
    first = F.greatest(F.lit(0), start - context_start)
    last = F.least(size, end - context_start)
    back = mirrored(first, last, size)
    minus = strand == "-"
    return F.when(minus, back[0]).otherwise(first).cast("int"), F.when(minus, back[1]).otherwise(last).cast("int")


def oriented_pool_span(
    strand: Column, context_start: Column, context_end: Column, pool_start: Column, pool_end: Column
) -> tuple[Column, Column]:
    """Genome coordinates of offsets in an oriented window; strands other than ``-`` count forwards."""
    minus = strand == "-"
    return (
        F.when(minus, context_end - pool_end).otherwise(context_start + pool_start).cast("long"),
        F.when(minus, context_end - pool_start).otherwise(context_start + pool_end).cast("long"),
    )


def baseline_roi_span(
    scope: Column, chrom_length: Column, start: Column, end: Column, strand: Column, context_start: Column,
    context_end: Column, pool_start: Column, pool_end: Column,
) -> tuple[Column, Column]:
    """The span that a row's score statistics are taken over.

    The pooled 100 bp for scope ``100bp``, else what the symmetric context of the region has of it, whatever the
    row's own policy. Another scope raises when the row is evaluated.
    """
    pooled = oriented_pool_span(strand, context_start, context_end, pool_start, pool_end)
    around = context_bounds(chrom_length, start, end, strand, policy="symmetric")
    low, high = ordered_bounds(start, end)
    bad = F.raise_error(F.concat(F.lit("unsupported scope: "), F.coalesce(scope, F.lit("null")))).cast("long")
    whole = scope.isin("full", "roi")
    return (
        F.when(scope == "100bp", pooled[0]).when(whole, F.greatest(low, around[0])).otherwise(bad),
        F.when(scope == "100bp", pooled[1]).when(whole, F.least(high, around[1])).otherwise(bad),
    )


def upstream_tss(start: Column, end: Column, strand: Column, size: int = 2000) -> tuple[Column, Column]:
    """The flank of ``size`` bases before the transcription start; it may leave the contig."""
    plus = strand == "+"
    return F.when(plus, start - size).otherwise(end), F.when(plus, start).otherwise(end + size)


def shifted_flank(start: Column, end: Column, strand: Column, distance: int) -> tuple[Column, Column]:
    """An interval of equal length ``distance`` bases upstream; strands other than ``-`` look to the left."""
    size = end - start
    minus = strand == "-"
    return F.when(minus, end + distance).otherwise(start - distance - size), F.when(minus, end + distance + size).otherwise(start - distance)


def within_contig(start: Column, end: Column, chrom_length: Column) -> Column:
    return (start >= 0) & (end <= chrom_length)


def assign_split(chrom: Column, held_out: tuple[str, ...] = TEST_CONTIGS) -> Column:
    return F.when(chrom.isin(*held_out), F.lit("test")).otherwise(F.lit("train"))


def composite_key(*parts: Column) -> Column:
    return F.concat_ws("|", *[p.cast("string") for p in parts])

"""Sequence expressions: complement, slices, motifs, spliced blocks and reading frames."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Bases and their complements; other letters stay.
_BASES, _COMPLEMENTS = "ACGTNacgtn", "TGCANtgcan"
# Letters and the bases they are read as.
LETTERS, BASES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTNN"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, _BASES, _COMPLEMENTS))


def slice_of(seq: Column, start: Column, end: Column) -> Column:
    """Bases ``[start, end)`` of a text that starts at 0."""
    return F.substr(seq, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))


def motif_positions(seq: Column, motif: str = "ATG") -> Column:
    """Ascending start offsets of a motif that cannot overlap itself, in one pass over the text."""
    n = len(motif)
    if any(motif.startswith(motif[k:]) for k in range(1, n)):
        raise ValueError(f"{motif!r} can overlap itself")
    ends = lambda gaps: F.aggregate(
        F.slice(gaps, F.lit(1), F.size(gaps) - 1),
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<bigint>)").alias("all")),
        lambda a, g: F.struct(
            (a["at"] + F.char_length(g) + n).alias("at"), F.array_append(a["all"], a["at"] + F.char_length(g)).alias("all")
        ),
        lambda a: a["all"],
    )
    # the text is split once; a null text has a null in its array, and no positions
    return F.get(F.transform(F.array(F.split(seq, motif, -1)), lambda gaps: F.when(gaps.isNotNull(), ends(gaps))), F.lit(0))


def letters_as_bases(text: Column) -> Column:
    """The letters A to Z of a text, in either case, read as bases; all other characters go.

    Bytes are looked up in a table, in Arrow batches: ``translate`` with a pattern took some 300 ns a byte.
    """
    table = bytes.maketrans((LETTERS + LETTERS.lower()).encode(), (BASES * 2).encode())
    others = bytes(k for k in range(256) if not chr(k).isascii() or not chr(k).isalpha())

    @F.pandas_udf("string")
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t.encode().translate(table, others).decode(), na_action="ignore")

    return read(text)


def trimmed_blocks(segments: Column, strand: Column) -> Column:
    """Coding blocks ``(start, end, offset)`` of ``(start, end, phase)`` segments, in the direction of the strand.

    The first segment loses its phase (only 0, 1 and 2 count); empty blocks go; ``offset`` is the length of the
    blocks before.
    """
    minus = strand == "-"
    ordered = F.when(minus, F.sort_array(segments, asc=False)).otherwise(F.sort_array(segments))

    def trim(s: Column, k: Column) -> Column:
        cut = F.when((k == 0) & s["phase"].isin(0, 1, 2), s["phase"]).otherwise(F.lit(0)).cast("long")
        return F.struct(
            F.when(minus, s["start"]).otherwise(F.least(s["end"], s["start"] + cut)).alias("start"),
            F.when(minus, F.greatest(s["start"], s["end"] - cut)).otherwise(s["end"]).alias("end"),
        )

    kept = F.filter(F.transform(ordered, trim), lambda b: b["start"] < b["end"])
    return F.aggregate(
        kept,
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint,offset:bigint>>)").alias("all")),
        lambda a, b: F.struct(
            (a["at"] + b["end"] - b["start"]).alias("at"),
            F.array_append(a["all"], F.struct(b["start"].alias("start"), b["end"].alias("end"), a["at"].alias("offset"))).alias("all"),
        ),
        lambda a: a["all"],
    )


def blocks_length(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("long"), lambda n, b: n + b["end"] - b["start"])


def spliced_sequence(seq: Column, blocks: Column, strand: Column, compat: bool = True) -> Column:
    """The blocks' bases, on the strand.

    ``compat`` joins forward slices in block order and complements the whole, as published outputs have it: the
    exons of a minus transcript of several come out in reverse order. Without it each block is complemented.
    """
    minus = strand == "-"
    plain = F.array_join(F.transform(blocks, lambda b: slice_of(seq, b["start"], b["end"])), "")
    if compat:
        return F.when(minus, reverse_complement(plain)).otherwise(plain)
    turned = F.array_join(F.transform(blocks, lambda b: reverse_complement(slice_of(seq, b["start"], b["end"]))), "")
    return F.when(minus, turned).otherwise(plain)


def genomic_position(blocks: Column, offset: Column, strand: Column) -> Column:
    """Genome coordinate of a transcript offset, null outside the blocks."""
    hit = F.get(F.filter(blocks, lambda b: (b["offset"] <= offset) & (offset < b["offset"] + b["end"] - b["start"])), F.lit(0))
    into = offset - hit["offset"]
    return F.when(strand == "+", hit["start"] + into).otherwise(hit["end"] - 1 - into)


def reading_frame(offset: Column) -> Column:
    """``start`` at offset 0, then ``inframe`` or ``outframe``."""
    return F.when(offset == 0, "start").when(F.pmod(offset, F.lit(3)) == 0, "inframe").otherwise("outframe")

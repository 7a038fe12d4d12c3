"""bigWig files as a Spark data source: intervals of a score track, read by contig and range.

The driver reads the header, the contig names and the upper levels of the range index, until it has enough branches that may
hold something of what is asked for. Each task takes some branches, follows them to their data blocks, and reads and
unpacks only blocks that overlap the range. Files are read through Arrow's file systems, so paths may be remote.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import make_importable

# Fixed values of the file format: the numbers that begin a file, its contig tree and its range index, and the kinds of data blocks.
FILE_MAGIC, CONTIG_MAGIC, INDEX_MAGIC = 0x888FFC26, 0x78CA8C91, 0x2468ACE0
BED_GRAPH, VARIABLE_STEP, FIXED_STEP = 1, 2, 3

#: Branches of the index that tasks are made of, at least where the index has as many.
BRANCHES = 256
NAME = "bigwig_track"
SCHEMA = "chrom string, start long, end long, value double"


class Bytes:
    """A file read piece by piece in its byte order."""

    def __init__(self, path: str, order: str = "<"):
        store, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        self.file, self.order = store.open_input_file(name), order

    def at(self, offset: int, n: int) -> bytes:
        data = self.file.read_at(n, offset)
        if len(data) < n:
            raise ValueError(f"the file ends within {n} bytes at {offset}")
        return data

    def fields(self, offset: int, kinds: str) -> tuple:
        kinds = self.order + kinds
        return struct.unpack(kinds, self.at(offset, struct.calcsize(kinds)))

    def items(self, offset: int, kinds: str, count: int) -> list[tuple]:
        kinds = self.order + kinds
        return list(struct.iter_unpack(kinds, self.at(offset, struct.calcsize(kinds) * count)))


@dataclass
class Header:
    order: str
    contigs: dict[int, tuple[str, int]]  # name and length by number
    index: int
    packed: bool


def read_header(path: str) -> tuple[Bytes, Header]:
    """The open file, and what its header says. Raises ValueError for another kind of file."""
    data = Bytes(path)
    for order in "<>":
        data.order = order
        if data.fields(0, "I")[0] == FILE_MAGIC:
            break
    else:
        raise ValueError(f"{path} is no bigWig file")
    _, _, _, contigs, _, index, _, _, _, _, buffer, _ = data.fields(0, "IHHQQQHHQQIQ")
    return data, Header(data.order, _contigs(data, contigs), index, buffer > 0)


def _contigs(data: Bytes, offset: int) -> dict[int, tuple[str, int]]:
    magic, _, key, _, _, _ = data.fields(offset, "IIIIQQ")
    if magic != CONTIG_MAGIC:
        raise ValueError("the contig tree is damaged")
    out, todo = {}, [offset + 32]
    while todo:
        at = todo.pop()
        leaf, _, count = data.fields(at, "BBH")
        if leaf:
            for name, number, length in data.items(at + 4, f"{key}sII", count):
                out[number] = name.rstrip(b"\0").decode(), length
        else:
            todo += [child for _, child in data.items(at + 4, f"{key}sQ", count)]
    return out


@dataclass
class Wanted:
    """Contigs (by number; None: all) and a range of bases."""

    contigs: set[int] | None
    start: int
    end: int

    def meets(self, first: int, start: int, last: int, end: int) -> bool:
        """Whether a node from (first, start) to (last, end) may hold something of it."""
        if self.contigs is not None and not any(first <= c <= last for c in self.contigs):
            return False
        return first != last or (start < self.end and self.start < end)


def _children(data: Bytes, at: int, wanted: Wanted) -> tuple[bool, list[tuple[int, int]]]:
    """Whether a node is a leaf, and (offset, size) of the children that may hold something of ``wanted``."""
    leaf, _, count = data.fields(at, "BBH")
    items = data.items(at + 4, "IIIIQQ" if leaf else "IIIIQ", count)
    return bool(leaf), [(x[4], x[5] if leaf else 0) for x in items if wanted.meets(*x[:4])]


def branches(data: Bytes, index: int, wanted: Wanted, least: int = BRANCHES) -> list[int]:
    """Offsets of index nodes that together lead to all that is wanted: whole levels, from the top until there are enough."""
    magic, _, items = data.fields(index, "IIQ")
    if magic != INDEX_MAGIC:
        raise ValueError("the range index is damaged")
    level = [index + 48] if items else []
    while level and len(level) < least:
        found = [_children(data, at, wanted) for at in level]
        if any(leaf for leaf, _ in found):
            return level
        level = [offset for _, children in found for offset, _ in children]
    return level


def blocks(data: Bytes, at: int, wanted: Wanted) -> Iterator[tuple[int, int]]:
    """(offset, size) of the data blocks below a node that may hold something of ``wanted``."""
    leaf, children = _children(data, at, wanted)
    for offset, size in children:
        if leaf:
            yield offset, size
        else:
            yield from blocks(data, offset, wanted)


def intervals(block: bytes, order: str) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Contig number, starts, ends and values of an unpacked data block."""
    contig, start, _, step, span, kind, _, count = struct.unpack(f"{order}IIIIIBBH", block[:24])
    body = block[24:]
    if kind == BED_GRAPH:
        rows = np.frombuffer(body, np.dtype([("s", f"{order}u4"), ("e", f"{order}u4"), ("v", f"{order}f4")]), count)
        return contig, rows["s"].astype(np.int64), rows["e"].astype(np.int64), rows["v"].astype(np.float64)
    if kind == VARIABLE_STEP:
        rows = np.frombuffer(body, np.dtype([("s", f"{order}u4"), ("v", f"{order}f4")]), count)
        starts, values = rows["s"].astype(np.int64), rows["v"]
    elif kind == FIXED_STEP:
        values = np.frombuffer(body, f"{order}f4", count)
        starts = start + step * np.arange(count, dtype=np.int64)
    else:
        raise ValueError(f"unknown kind {kind} of data block")
    return contig, starts, starts + span, values.astype(np.float64)


@dataclass
class Branches(InputPartition):
    offsets: list[int]


class TrackReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.names = [x for x in options.get("contigs", "").split("\n") if x]
        self.start, self.end = int(options.get("start", 0)), int(options.get("end", 1 << 62))

    def _open(self) -> tuple[Bytes, Header, Wanted]:
        data, header = read_header(self.path)
        chosen = {k for k, (name, _) in header.contigs.items() if name in self.names} if self.names else None
        return data, header, Wanted(chosen, self.start, self.end)

    def partitions(self) -> list[InputPartition]:
        data, header, wanted = self._open()
        found = branches(data, header.index, wanted)
        per = -(-len(found) // BRANCHES) or 1
        return [Branches(found[k : k + per]) for k in range(0, len(found), per)] or [Branches([])]

    def read(self, partition: Branches) -> Iterator[pa.RecordBatch]:
        data, header, wanted = self._open()
        for offset, size in (b for at in partition.offsets for b in blocks(data, at, wanted)):
            block = data.at(offset, size)
            contig, starts, ends, values = intervals(zlib.decompress(block) if header.packed else block, header.order)
            if wanted.contigs is not None and contig not in wanted.contigs:
                continue
            good = (starts < self.end) & (ends > self.start)
            n = int(good.sum())
            if n:
                # a part of an interval that lies outside the range is no answer to it
                yield pa.record_batch(
                    [pa.array([header.contigs[contig][0]] * n, pa.string()), pa.array(np.maximum(starts[good], self.start)), pa.array(np.minimum(ends[good], self.end)), pa.array(values[good])],
                    names=["chrom", "start", "end", "value"],
                )


class Track(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TrackReader:
        return TrackReader(dict(self.options))


def scan_bigwig(spark: SparkSession, path: str, contigs: list[str] | None = None, start: int = 0, end: int | None = None) -> DataFrame:
    """(chrom, start, end, value) of a bigWig file: of all contigs or those named, clipped to ``[start, end)``.

    A contig that the file lacks has no intervals, and neither has a range without data: statistics over them are
    those of zeros. A file that is no bigWig file raises.
    """
    make_importable(spark)
    spark.dataSource.register(Track)
    if contigs is not None and not contigs:
        return spark.createDataFrame([], SCHEMA)
    read = spark.read.format(NAME).option("start", start)
    read = read if end is None else read.option("end", end)
    return (read if contigs is None else read.option("contigs", "\n".join(contigs))).load(path)


def bigwig_contigs(path: str) -> dict[str, int]:
    """Lengths of the contigs that a bigWig file names."""
    return dict(read_header(path)[1].contigs.values())

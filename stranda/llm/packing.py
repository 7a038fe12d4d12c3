"""Best-fit packing of token pieces into sequences, improved by swap-based local search.

Texts longer than a sequence are cut into full pieces and a shorter last one; everything else stays
whole. Pieces (a few numbers each, never ids or texts) are dealt by hash into groups of bounded size that
are packed apart from each other, so no task grows with the input. Best-fit-decreasing gives the first
packing of a group. Local search then raises the sum of squared fills: pieces of underfull bins, the emptiest
first, move into other bins or change places, one for one or two for one, with pieces of any other underfull
bin. Of all such steps the one that gains most is taken, until no step gains or no fewer bins are possible (the
sum of sizes fills the bins that are left). Squared fills only grow, so the search ends.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, materialize, release, small_batches, text_bytes
from .sharding import best_fit_decreasing
from .token_files import with_ends
from .tokens import encoder, vocabulary

LENGTH = 2048
#: Pieces packed together, on average.
GROUP_PIECES = 16_384
#: Bytes of text encoded at once, and what an encoder remembers: little, as the pipeline packs in executors that earlier stages have filled.
BATCH_BYTES, REMEMBERED = 1 << 20, {"max_pieces": 100_000, "max_ids": 1_000_000}
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def piece_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int | None, length: int) -> Iterator[pa.RecordBatch]:
    """The pieces of batches of doc_id and ``_bytes``."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), *((c, pa.int64()) for c in ("start", "length", "ids_crc32"))]
    )
    for batch in gathered(batches, BATCH_BYTES):
        ids, counts = with_ends(*encoder(path, **REMEMBERED).encode(batch.column("_bytes").to_pylist()), end_id)
        raw, at, out = memoryview(ids.astype("<u4").tobytes()), 0, []
        for doc_id, n in zip(batch.column("doc_id").to_pylist(), counts.tolist(), strict=True):
            for piece, k in enumerate(range(0, n, length)):
                m = min(length, n - k)
                out.append((doc_id, piece, k, m, zlib.crc32(raw[4 * (at + k) : 4 * (at + k + m)])))
            at += n
        if out:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        release()


def cut_pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = 0, length: int = LENGTH) -> DataFrame:
    """A row for each piece of ``docs`` (doc_id, text, ...): doc_id, piece, start, length, ids_crc32."""
    small_batches(docs.sparkSession)
    path = tokenizer or vocabulary()
    return text_bytes(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id").mapInArrow(lambda batches: piece_batches(batches, path, end_id, length), PIECES)


class _Bins:
    """Pieces of a group in their bins, with what local search asks of them."""

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int):
        self.sizes, self.bins, self.capacity = sizes, bins, capacity
        self.size, self.home = np.array(sizes, np.int64), np.zeros(len(sizes), np.int64)
        for k, b in enumerate(bins):
            self.home[b] = k
        self.fill = np.bincount(self.home, self.size, len(bins)).astype(np.int64)
        # fewer bins than this cannot hold all pieces
        self.least = -(-int(self.size.sum()) // capacity)
        self.used = int((self.fill > 0).sum())

    def sums(self, low: int, pieces: int) -> tuple[np.ndarray, dict[int, tuple[int, ...]]]:
        """The largest sum, up to each size, of one piece of bin ``low`` or of up to two, and the pieces of each sum."""
        of_size: dict[int, list[int]] = defaultdict(list)
        for p in self.bins[low]:
            of_size[self.sizes[p]].append(p)
        found = {s: (held[0],) for s, held in of_size.items()}
        if pieces == 2:
            distinct = sorted(of_size)
            for k, s in enumerate(distinct):
                for t in distinct[k:]:
                    if s + t <= self.capacity and s + t not in found and (s != t or len(of_size[s]) > 1):
                        found[s + t] = (of_size[s][0], of_size[t][-1])
        reach = np.zeros(self.capacity + 1, np.int64)
        at = np.fromiter(found, np.int64, len(found))
        reach[at] = at
        return np.maximum.accumulate(reach), found

    def step(self, low: int) -> bool:
        """Of all moves and exchanges between bin ``low`` and other underfull bins, make the one that gains most, if any gains."""
        room = self.capacity - self.fill
        room[low] = 0
        bins = np.flatnonzero((room > 0) & (self.fill > 0))
        if not len(bins) or not self.bins[low]:
            return False
        one, ones = self.sums(low, 1)
        two, twos = self.sums(low, 2)
        others = np.flatnonzero(room[self.home] > 0)
        at = np.concatenate((bins, self.home[others]))
        back = np.concatenate((np.zeros(len(bins), np.int64), self.size[others]))
        out = np.concatenate((one[room[bins]], two[room[self.home[others]] + self.size[others]]))
        moved = out - back
        # what ``moved`` more ids in the other bin and fewer in this one add to the sum of squared fills
        gain = np.where(moved > 0, 2 * moved * (self.fill[at] - self.fill[low] + moved), 0)
        best = int(gain.argmax())
        if gain[best] <= 0:
            return False
        high, total = int(at[best]), int(out[best])
        back_piece = None if best < len(bins) else int(others[best - len(bins)])
        for p in (ones if back_piece is None else twos)[total]:
            self._put(p, low, high)
        if back_piece is not None:
            self._put(back_piece, high, low)
        if not self.bins[low]:
            self.used -= 1
        return True

    def _put(self, p: int, low: int, high: int) -> None:
        self.bins[low].remove(p)
        self.bins[high].append(p)
        self.home[p] = high
        self.fill[low] -= self.sizes[p]
        self.fill[high] += self.sizes[p]


def local_search(sizes: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Improve a packing until nothing improves or no fewer bins are possible; never needs more bins."""
    x = _Bins(sizes, bins, capacity)
    changed = True
    while changed and x.used > x.least:
        changed = False
        for low in np.lexsort((np.arange(len(bins)), x.fill)).tolist():
            while x.used > x.least and 0 < x.fill[low] < capacity and x.step(low):
                changed = True
    return [b for b in bins if b]


def pack(sizes: list[int], capacity: int = LENGTH) -> list[list[int]]:
    """Bins of positions in ``sizes``, each of at most ``capacity``."""
    bins = best_fit_decreasing([(s, k) for k, s in enumerate(sizes)], capacity)
    return local_search(sizes, bins, capacity)


def pack_pieces(pieces: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset (gapless from 0 in each sequence) to a written table of pieces."""
    spark = pieces.sparkSession
    numbered = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, round(numbered.count() / group_pieces))

    def in_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_row"], kind="stable").reset_index(drop=True)
        sizes = rows["length"].tolist()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for number, held in enumerate(pack(sizes, length)):
            at = 0
            for p in held:
                sequence[p], offset[p] = (int(key[0]) << 32) + number, at
                at += sizes[p]
        return rows.drop(columns=["_row", "_group"]).assign(sequence_id=sequence, offset=offset)

    grouped = numbered.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return grouped.groupBy("_group").applyInPandas(in_group, f"{schema}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, end_id: int | None = 0, length: int = LENGTH, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """Pack ``docs`` (doc_id, text, ...; other columns are ignored) into sequences of at most ``length`` ids.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty text is the end
    id alone. Null and repeated doc_ids are packed like any other. An empty table gives no rows.
    """
    return pack_pieces(cut_pieces(docs, tokenizer, end_id, length), length, group_pieces)

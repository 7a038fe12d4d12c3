"""Word-aligned coding of unsigned ids: a 4-bit selector and as many equally wide ids as fit 60 bits.

A file holds blocks and a footer. A block: three unsigned 32-bit numbers (ids, words, escapes), the 64-bit
words, the escapes' places (unsigned 32-bit) and the escapes (unsigned 64-bit). An escape is an id wider
than the block's limit, for which the words hold 0; the limit is the width that makes the block smallest.
The footer: a row for each document (doc_id signed 64-bit, whether it is null, number of ids), then the
offsets of the blocks (unsigned 64-bit), then a trailer of fixed size. All numbers are little-endian.
"""

from __future__ import annotations

import struct
from typing import BinaryIO

import numpy as np

#: Ids in a word and bits of each, by selector. Fixed values of the published code.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

BLOCK_IDS = 1 << 16
MAGIC = b"S8BIDS01"
_TRAILER = struct.Struct("<QQQQ8s")
_U64 = np.uint64


_SHORT = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)


def _bit_widths(ids: np.ndarray) -> np.ndarray:
    if not len(ids) or int(ids.max()) < len(_SHORT):
        return _SHORT[ids.astype(np.int64)]
    wide = np.zeros(len(ids), np.uint8)
    rest = ids.copy()
    for step in (32, 16, 8, 4, 2, 1):
        over = rest >= _U64(1 << step)
        wide[over] += step
        rest[over] >>= _U64(step)
    return wide + (rest > 0)


def _selectors(widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and selector of each word: always the selector that takes most ids."""
    n = len(widths)
    best = np.full(n, len(COUNTS) - 1, np.int8)
    padded = np.concatenate((widths, np.zeros(COUNTS[0], np.uint8)))
    for s in range(len(COUNTS) - 2, -1, -1):
        bad = np.zeros(len(padded) + 1, np.int32)
        np.cumsum(padded > WIDTHS[s], out=bad[1:])
        if bad[-1] > len(padded) - COUNTS[s]:
            break
        best[bad[COUNTS[s] : COUNTS[s] + n] == bad[:n]] = s
    step, at, starts = np.array(COUNTS)[best].tolist(), 0, []
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    return starts, best[starts]


def encode_words(ids: np.ndarray) -> np.ndarray:
    """Words of ids that are all under 2**60."""
    ids = ids.astype(_U64)
    starts, chosen = _selectors(_bit_widths(ids))
    padded = np.concatenate((ids, np.zeros(COUNTS[0], _U64)))
    words = chosen.astype(_U64) << _U64(60)
    for s in range(2, len(COUNTS)):
        own = np.flatnonzero(chosen == s)
        if len(own):
            taken = padded[starts[own][:, None] + np.arange(COUNTS[s])]
            words[own] |= np.bitwise_or.reduce(taken << (np.arange(COUNTS[s]) * WIDTHS[s]).astype(_U64), axis=1)
    return words


def decode_words(words: np.ndarray, n: int) -> np.ndarray:
    chosen = (words >> _U64(60)).astype(np.int64)
    ends = np.cumsum(np.array(COUNTS)[chosen])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, _U64)
    for s in range(2, len(COUNTS)):
        own = np.flatnonzero(chosen == s)
        if len(own):
            k = np.arange(COUNTS[s])
            values = (words[own][:, None] >> (k * WIDTHS[s]).astype(_U64)) & _U64((1 << WIDTHS[s]) - 1)
            out[(ends[own] - COUNTS[s])[:, None] + k] = values
    return out[:n]


def _limit(widths: np.ndarray) -> int:
    """The width beyond which ids of this block are escapes: the one with the fewest bits, escapes taking 96."""
    hist = np.bincount(widths, minlength=65)
    over = np.concatenate((np.cumsum(hist[::-1])[::-1][1:], [0]))
    common = [w for w in WIDTHS[2:] if over[w] * 50 <= len(widths) or w == 60]
    return min(common, key=lambda w: (len(widths) * 60 // (60 // w) + 96 * int(over[w]), w))


def encode_block(ids: np.ndarray) -> bytes:
    ids = ids.astype(_U64)
    widths = _bit_widths(ids)
    odd = np.flatnonzero(widths > _limit(widths)) if len(ids) else np.zeros(0, np.int64)
    escaped = ids[odd]
    ids[odd] = 0
    words = encode_words(ids)
    return b"".join(
        (struct.pack("<III", len(ids), len(words), len(odd)), words.astype("<u8").tobytes(), odd.astype("<u4").tobytes(), escaped.astype("<u8").tobytes())
    )


def decode_block(data: bytes) -> np.ndarray:
    n, n_words, n_odd = struct.unpack_from("<III", data)
    at = 12 + 8 * n_words
    ids = decode_words(np.frombuffer(data, "<u8", n_words, 12), n)
    if n_odd:
        ids[np.frombuffer(data, "<u4", n_odd, at)] = np.frombuffer(data, "<u8", n_odd, at + 4 * n_odd)
    return ids


class Writer:
    """Documents in their order into one open file; holds one block of ids and a number or two for each document."""

    def __init__(self, out: BinaryIO, block_ids: int = BLOCK_IDS):
        self.out, self.block_ids = out, block_ids
        self.offsets: list[int] = []
        self.keys: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.open: list[np.ndarray] = []
        self.held = self.at = self.total = 0

    def add(self, doc_ids: list[int | None], ids: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(np.array([d or 0 for d in doc_ids], "<i8"))
        self.nulls.append(np.array([d is None for d in doc_ids], "u1"))
        self.counts.append(counts.astype("<u8"))
        self.open.append(ids)
        self.held += len(ids)
        if self.held >= self.block_ids:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.open) if self.open else np.zeros(0, np.uint32)
        end = len(ids) if last else len(ids) // self.block_ids * self.block_ids
        for k in range(0, end, self.block_ids):
            block = encode_block(ids[k : min(end, k + self.block_ids)])
            self.out.write(block)
            self.offsets.append(self.at)
            self.at += len(block)
        self.total += end
        self.open, self.held = [ids[end:]], len(ids) - end

    def close(self) -> tuple[int, int]:
        """Numbers of documents and of ids."""
        self._flush(True)
        n = sum(map(len, self.keys))
        for parts in (self.keys, self.nulls, self.counts):
            self.out.write(b"".join(p.tobytes() for p in parts))
        self.out.write(np.array([*self.offsets, self.at], "<u8").tobytes())
        self.out.write(_TRAILER.pack(n, len(self.offsets), self.at, self.total, MAGIC))
        return n, self.total


class Reader:
    """A seekable file; documents one after the other, or any range of ids through the blocks' offsets."""

    def __init__(self, file: BinaryIO, size: int, block_ids: int = BLOCK_IDS):
        self.file, self.block_ids = file, block_ids
        file.seek(size - _TRAILER.size)
        n, blocks, footer, self.total, magic = _TRAILER.unpack(file.read(_TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a file of encoded ids")
        file.seek(footer)
        keys = np.frombuffer(file.read(8 * n), "<i8")
        nulls = np.frombuffer(file.read(n), "u1")
        self.counts = np.frombuffer(file.read(8 * n), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(file.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self.doc_ids = [None if z else k for k, z in zip(keys.tolist(), nulls.tolist(), strict=True)]

    def block(self, k: int) -> np.ndarray:
        self.file.seek(int(self.offsets[k]))
        return decode_block(self.file.read(int(self.offsets[k + 1] - self.offsets[k])))

    def ids(self, start: int, stop: int) -> np.ndarray:
        if start >= stop:
            return np.zeros(0, _U64)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        got = np.concatenate([self.block(k) for k in range(first, last + 1)])
        return got[start - first * self.block_ids : stop - first * self.block_ids]

    def documents(self):
        """(doc_id, ids) in file order; each block is decoded once and at most one document is held beyond it."""
        held, at, k = np.zeros(0, _U64), 0, 0
        for doc_id, n in zip(self.doc_ids, self.counts.tolist(), strict=True):
            parts, have = [held[at:]], len(held) - at
            if have < n:
                while have < n:
                    parts.append(self.block(k))
                    have += len(parts[-1])
                    k += 1
                held, at = np.concatenate(parts), 0
            yield doc_id, held[at : at + n]
            at += n

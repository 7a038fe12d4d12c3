"""Words of whole texts as arrays of 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash

_U64 = np.uint64

#: Words remembered by a worker process with their hashes; bounds memory, never results.
REMEMBERED = 150_000
_hashes: dict[bytes, int] = {}


def forget() -> None:
    """Free what is remembered, before other work in the same process."""
    _hashes.clear()


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads every bit (the public splitmix64 finalizer)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def word_codes(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the code of each word of all texts, and the offset of each text's first word.

    Words are runs of bytes other than white space U+0009-U+000D and U+0020. There is one more offset at
    the end.
    """
    split = [t.split() for t in texts]
    edges = np.concatenate(([0], np.cumsum([len(s) for s in split]))).astype(np.int64)
    if not edges[-1]:
        return [], np.zeros(0, np.int64), edges
    coded = pa.array(list(chain.from_iterable(split)), pa.binary()).dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), edges


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` and the offset of each text's first word (one more at the end)."""
    words, codes, edges = word_codes(texts)
    if not words:
        return np.zeros(0, np.uint64), edges
    known = list(map(_hashes.get, words))
    if None in known:
        if len(_hashes) > REMEMBERED:
            _hashes.clear()
        for k, h in enumerate(known):
            if h is None:
                known[k] = _hashes[words[k]] = xxhash.xxh64_intdigest(words[k])
    return np.array(known, np.uint64)[codes], edges


def windows(hashes: np.ndarray, edges: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word and text of every run of ``n`` words that lies within one text."""
    counts = np.diff(edges)
    per = np.maximum(counts - n + 1, 0)
    total = int(per.sum())
    owner = np.repeat(np.arange(len(counts)), per)
    first = np.repeat(edges[:-1] - np.cumsum(per) + per, per) + np.arange(total)
    if not total:
        return np.zeros(0, np.uint64), first, owner
    rolled = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        rolled = rolled * _U64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - n + 1 + k]
    return mix(rolled[first]), first, owner

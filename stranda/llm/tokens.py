"""Public tokenizers applied to whole texts, each distinct piece of text encoded once.

Some tokenizers lower-case a text, drop its white space and cut it by a pattern into pieces that their
model encodes apart from each other. For those, ``PieceEncoder`` cuts texts by the same pattern, has the
model of the ``tokenizers`` library encode each distinct piece once, remembers the ids and puts texts
together by array operations. Texts with characters from U+0240 on or with special tokens, and all texts
of other tokenizers, are encoded whole by the library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa

from . import words

_encoders: dict[tuple, PieceEncoder] = {}

#: The pre-tokenizer's pattern for which pieces are cut here. A fixed value of the public vocabulary file.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: UTF-8 bytes of characters from U+0240 on; without them all characters are in composed form and lower-case one by one.
HIGH = bytes(range(0xC9, 0x100))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, **bounds: int) -> PieceEncoder:
    """One encoder for each worker process, kept between tasks; ``bounds`` are those of ``PieceEncoder``."""
    words.forget()
    key = (path, *sorted(bounds.items()))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = PieceEncoder(path, **bounds)
    return _encoders[key]


#: Characters below U+0240, combining marks, and what the former lower-case to (U+023A and U+023E leave the range).
PLAIN = sorted({*map(chr, range(0x370)), *"".join(chr(c).lower() for c in range(0x240))})


def _char_class(wanted) -> str:
    return "".join(re.escape(c) for c in PLAIN if wanted(c))


def _plain_pattern() -> re.Pattern[str]:
    """``PIECES`` for plain characters and what they lower-case to, as classes the standard library matches fast."""
    letters = _char_class(lambda c: unicodedata.category(c)[0] == "L")
    numbers = _char_class(lambda c: unicodedata.category(c)[0] == "N")
    space = re.escape("\t\n\v\f\r \x85\xa0")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + k) for k, b in enumerate(other)}


def cut_by_pieces(spec: dict) -> bool:
    """Whether a vocabulary file describes the pipeline that pieces are cut for."""
    norm = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = pre[0] if len(pre) == 2 else {}
    return (
        norm == ["NFC", "Replace", "Lowercase"]
        and (split.get("pattern") or {}).get("Regex") == PIECES
        and (split.get("behavior"), split.get("invert")) == ("Removed", True)
        and pre[1].get("type") == "ByteLevel"
        and not pre[1].get("add_prefix_space")
        and not pre[1].get("use_regex")
        and spec["model"].get("type") == "BPE"
    )


class PieceEncoder:
    """Ids of texts; ``max_pieces`` and ``max_ids`` bound what is remembered, never what is encoded."""

    def __init__(self, path: str, max_pieces: int = 400_000, max_ids: int = 4_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pieces = _plain_pattern() if cut_by_pieces(spec) else None
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.letters = _byte_letters()
        self.max_pieces, self.max_ids = max_pieces, max_ids
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.pool = np.zeros(1024, np.uint32)
        self.used = 0
        self.starts = np.zeros(1024, np.int64)
        self.counts = np.zeros(1024, np.int64)
        self.hits = np.zeros(1024, np.int64)

    def _keep_frequent(self) -> None:
        """Forget pieces that only one batch had; all, if that does not free half."""
        keep = np.flatnonzero(self.hits[: len(self.slot)] > 1)
        if 2 * len(keep) > self.max_pieces or 2 * int(self.counts[keep].sum()) > self.max_ids:
            self._forget()
            return
        pieces, counts = list(self.slot), self.counts[keep]
        ends = np.cumsum(counts)
        n = int(ends[-1]) if len(ends) else 0
        pool = self.pool[np.repeat(self.starts[keep] - ends + counts, counts) + np.arange(n)]
        self._forget()
        self.slot = {pieces[k]: new for new, k in enumerate(keep.tolist())}
        self.pool, self.used = np.concatenate((pool, np.zeros(1024, np.uint32))), n
        spare = np.zeros(1024, np.int64)
        self.starts, self.counts = np.concatenate((ends - counts, spare)), np.concatenate((counts, spare))
        self.hits = np.zeros(len(self.starts), np.int64)

    def _learn(self, pieces: list[str]) -> None:
        encode, letters = self.tokenizer.model.tokenize, self.letters
        ids = [
            [t.id for t in encode(p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(letters))] for p in pieces
        ]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        new = np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))
        n, m = len(self.slot), len(lengths)
        if self.used + len(new) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(len(self.pool) + len(new), np.uint32)))
        if n + m > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros(len(self.starts) + m, np.int64)))
            self.counts = np.concatenate((self.counts, np.zeros(len(self.counts) + m, np.int64)))
            self.hits = np.concatenate((self.hits, np.zeros(len(self.hits) + m, np.int64)))
        self.pool[self.used : self.used + len(new)] = new
        self.counts[n : n + m] = lengths
        self.starts[n : n + m] = self.used + np.cumsum(lengths) - lengths
        self.used += len(new)
        self.slot.update(zip(pieces, range(n, n + m), strict=True))

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        find = self.pieces.findall
        cut = [find(t.lower()) for t in texts]
        flat = list(chain.from_iterable(cut))
        if not flat:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        coded = pa.array(flat, pa.string()).dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.slot.get, pieces))
        if None in known:
            missing = [p for p, k in zip(pieces, known, strict=True) if k is None]
            if len(self.slot) + len(missing) > self.max_pieces or self.used > self.max_ids:
                self._keep_frequent()
                missing = [p for p in pieces if p not in self.slot]
            self._learn(missing)
            known = list(map(self.slot.__getitem__, pieces))
        distinct = np.array(known, np.int64)
        self.hits[distinct] += 1
        slots = distinct[coded.indices.to_numpy()]
        counts = self.counts[slots]
        ends = np.cumsum(counts)
        ids = self.pool[np.repeat(self.starts[slots] - ends + counts, counts) + np.arange(ends[-1])]
        edges = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum([len(c) for c in cut])))]
        return ids, np.diff(edges)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.uint32, int(counts.sum())), counts

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other (unsigned 32-bit) and the number of ids of each text."""
        decoded = [t.decode("utf-8", "replace") for t in texts]
        if self.pieces is None:
            return self._whole(decoded)
        odd = [k for k, t in enumerate(texts) if len(t.translate(None, HIGH)) < len(t) or any(s in t for s in self.special)]
        if not odd:
            return self._plain(decoded)
        apart = set(odd)
        rest = [k for k in range(len(decoded)) if k not in apart]
        parts: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(decoded)
        counts = np.zeros(len(decoded), np.int64)
        for some, way in ((odd, self._whole), (rest, self._plain)):
            ids, n = way([decoded[k] for k in some])
            counts[some] = n
            for k, part in zip(some, np.split(ids, np.cumsum(n)[:-1]) if some else [], strict=True):
                parts[k] = part
        return np.concatenate(parts), counts

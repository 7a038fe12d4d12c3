"""Benchmark decontamination: rare n-gram seeds, then local alignment of words.

The vocabulary of the benchmark is counted over all documents. Of each stretch of a test item's word trigrams the
share ``RARE_SHARE`` that is least expected in the corpus, by the frequencies of its words and by how many items
have it, are its seeds; copies of an item in the corpus do not make its seeds less rare. Around a document's seeds of an
item near one diagonal, Smith-Waterman alignment scores the passage against the whole item, so edited and
paraphrased copies count by what is left of them. A passage leaks an item from ``THRESHOLD`` of the item's own
score on, or from the score of ``LONG_WORDS`` equal words, whichever is less. Items of fewer than ``LEAST_WORDS``
words are looked for whole and unchanged. Alignment keeps two rows, so its memory grows with the passage only.

Words are lower-cased (A-Z) and ASCII punctuation separates them. The benchmark is applied in blocks of
about ``BLOCK_WORDS`` words, which bounds what is sent to the executors at any size of it.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, text_bytes, tidy
from .words import mix, windows, word_codes

SEED = 3
RARE_SHARE = 0.75
#: Trigrams of which the rare ones are chosen together, so that every part of an item has seeds, and least seeds of each part.
STRETCH, LEAST_SEEDS = 8, 2
#: Items with fewer words are searched for whole.
LEAST_WORDS = 6
MATCH, MISMATCH, GAP = 2, -1, -1
#: Least alignment score as a share of the item's score against itself.
THRESHOLD = 0.6
#: So many equal words in a row are a leak of any item, however long.
LONG_WORDS = 30
BLOCK_WORDS = 500_000

LEAK = "struct<item_id: bigint, score: double, first_word: bigint, n_words: bigint>"

_SEPARATE = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def normal(text: bytes | None) -> bytes:
    return (text or b"").lower().translate(_SEPARATE)


def _best_cell(passage: np.ndarray, item: np.ndarray, anchored: bool) -> tuple[int, int, int]:
    """Best alignment score of two sequences, with how much of the item and of the passage it ends after.

    It may begin anywhere, or at both beginnings only if ``anchored``.
    """
    ramp = np.arange(len(passage) + 1) * -GAP
    row = -ramp if anchored else np.zeros(len(passage) + 1, np.int64)
    best, of_item, of_passage = 0, 0, 0
    for k, word in enumerate(item):
        step = row + GAP
        np.maximum(row[:-1] + np.where(passage == word, MATCH, MISMATCH), step[1:], out=step[1:])
        if not anchored:
            np.maximum(step, 0, out=step)
        row = np.maximum.accumulate(step + ramp) - ramp
        j = int(row.argmax())
        if row[j] > best:
            best, of_item, of_passage = int(row[j]), k + 1, j
    return best, of_item, of_passage


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment score of two sequences of word ids, and the passage's aligned range."""
    score, i, end = _best_cell(passage, item, False)
    # from the end backwards; an alignment that scores at all has no more gaps than its matches pay for
    first = max(0, end - i - i * MATCH // -GAP)
    _, _, length = _best_cell(passage[first:end][::-1], item[:i][::-1], True)
    return score, end - length, end


class Items:
    """A block of test items: their words as numbers and, once words have been counted, their seeds."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.vocab: dict[bytes, int] = {}
        self.ids: list[int] = []
        self.words: list[np.ndarray] = []
        #: Items that are searched for whole, by their number of words.
        self.short: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for item_id, text in rows:
            words = normal(text).split()
            coded = np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words], np.int64)
            if len(words) >= LEAST_WORDS:
                self.ids.append(item_id)
                self.words.append(coded)
            elif words:
                self.short[len(words)].append((item_id, coded))

    def short_leaks(self, words: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, dict]]:
        """Text and leak of the first place in each text of each item that is searched for whole."""
        spread = mix(words.astype(np.uint64) + np.uint64(1))
        for n, items in self.short.items():
            run, first, text = windows(spread, edges, n)
            own = np.concatenate([windows(mix(w.astype(np.uint64) + np.uint64(1)), np.array([0, n]), n)[0] for _, w in items])
            order = np.argsort(own, kind="stable")
            lo, hi = np.searchsorted(own[order], run), np.searchsorted(own[order], run, side="right")
            seen: set[tuple[int, int]] = set()
            for k in np.flatnonzero(lo < hi).tolist():
                for o in order[lo[k] : hi[k]].tolist():
                    t, at = int(text[k]), int(first[k])
                    if (t, o) not in seen and np.array_equal(words[at : at + n], items[o][1]):
                        seen.add((t, o))
                        yield t, {"item_id": items[o][0], "score": 1.0, "first_word": at - int(edges[t]), "n_words": n}

    def key(self, words: np.ndarray) -> np.ndarray:
        """A number for each run of SEED words; negative where one is not of the vocabulary."""
        v, out = len(self.vocab) + 1, np.zeros(max(0, len(words) - SEED + 1), np.int64)
        odd = np.zeros(len(out), bool)
        for k in range(SEED):
            part = words[k : len(out) + k]
            out = out * v + part
            odd |= part < 0
        out[odd] = -1
        return out

    def choose(self, counts: np.ndarray) -> None:
        """Seeds by item from the counts of the vocabulary's words in the corpus."""
        share = np.log((counts + 1.0) / (counts.sum() + 1.0))
        keys = [self.key(w) for w in self.words]
        of_items: dict[int, int] = defaultdict(int)
        for k in keys:
            for x in set(k.tolist()):
                of_items[x] += 1
        found: list[tuple[int, int, int]] = []
        for item, (k, w) in enumerate(zip(keys, self.words, strict=True)):
            expected = sum(share[w[j : len(k) + j]] for j in range(SEED)) + np.log([of_items[x] for x in k.tolist()])
            for lo in range(0, len(k), STRETCH):
                order = lo + np.argsort(expected[lo : lo + STRETCH], kind="stable")
                keep = max(LEAST_SEEDS, int(np.ceil(RARE_SHARE * len(order))))
                found += [(int(k[o]), item, int(o)) for o in order[:keep]]
        found.sort()
        self.seeds, first = np.unique(np.array([f[0] for f in found], np.int64), return_index=True)
        self.first = np.append(first, len(found))
        self.item = np.array([f[1] for f in found], np.int64)
        self.offset = np.array([f[2] for f in found], np.int64)

    def code(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words, -1 for words that no item has, and the offsets of texts."""
        words, codes, edges = word_codes([normal(t) for t in texts])
        known = np.array([self.vocab.get(w, -1) for w in words], np.int64)
        return (known[codes] if len(words) else np.zeros(0, np.int64)), edges

    def leaks(self, texts: list[bytes]) -> list[list[dict]]:
        """For each text its leaks: item_id, score, first_word, n_words; the best passage of an item."""
        out: list[list[dict]] = [[] for _ in texts]
        words, edges = self.code(texts)
        for t, leak in self.short_leaks(words, edges):
            out[t].append(leak)
        key = self.key(words)
        if not len(key) or not len(self.seeds):
            return out
        at = np.flatnonzero(key >= 0)
        slot = np.minimum(np.searchsorted(self.seeds, key[at]), len(self.seeds) - 1)
        hit = self.seeds[slot] == key[at]
        at, slot = at[hit], slot[hit]
        text = np.searchsorted(edges, at, side="right") - 1
        inside = at + SEED <= edges[text + 1]
        at, slot, text = at[inside], slot[inside], text[inside]
        many = self.first[slot + 1] - self.first[slot]
        total = int(many.sum())
        posting = np.repeat(self.first[slot] - np.cumsum(many) + many, many) + np.arange(total)
        item, offset = self.item[posting], self.offset[posting]
        text, at = np.repeat(text, many), np.repeat(at, many)
        diagonal = at - edges[text] - offset
        order = np.lexsort((diagonal, item, text))
        text, item, offset, diagonal = text[order], item[order], offset[order], diagonal[order]
        size = np.array([len(w) for w in self.words], np.int64)
        needed = MATCH * np.minimum(THRESHOLD * size, LONG_WORDS)
        new = np.ones(total, bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (np.diff(diagonal) > size[item[1:]] // 4 + 2)
        starts = np.append(np.flatnonzero(new), total)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            t, i = int(text[lo]), int(item[lo])
            slack = int(size[i]) // 4 + 2
            begin = max(0, int(diagonal[lo]) - slack)
            end = min(int(edges[t + 1] - edges[t]), int(diagonal[hi - 1] + size[i]) + slack)
            passage = words[edges[t] + begin : edges[t] + end]
            if MATCH * int(np.isin(self.words[i], passage).sum()) < needed[i]:
                continue
            score, j, k = align(passage, self.words[i])
            if score >= needed[i] and score > best.get((t, i), (0,))[0]:
                best[t, i] = (score, begin + j, k - j)
        for (t, i), (score, first, n) in sorted(best.items()):
            share = score / (MATCH * int(size[i]))
            out[t].append({"item_id": self.ids[i], "score": share, "first_word": first, "n_words": n})
        return out


def _counted(docs: DataFrame, items: Items) -> np.ndarray:
    """Occurrences of the vocabulary's words in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total = np.zeros(len(own.vocab), np.int64)
        for batch in batches:
            words, _ = own.code(batch.column("_bytes").to_pylist())
            total += np.bincount(words[words >= 0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["word", "n"])

    out = np.zeros(len(items.vocab), np.int64)
    rows = text_bytes(docs).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n"))
    for word, n in rows.collect():  # at most the vocabulary of a block
        out[word] = n
    return out


def screen(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every row of ``docs`` with the columns ``keep`` and ``leaks``, an array of what it leaks of ``benchmark``.

    A leak has item_id, score (share of the item's own score), first_word and n_words (place in the text's
    words). Null and empty texts leak nothing; items without words are in no text. Items of fewer than LEAST_WORDS
    words leak where they occur whole. Repeated rows and items are each reported. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kept_fields = [docs.schema[k] for k in keep]
    texts = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).filter("text is not null")
    total = texts.agg(F.sum(F.size(F.split(F.col("text").cast("string"), r"\s+")))).head()[0] or 0
    blocks = max(1, -(-int(total) // block_words))
    deal = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    none = F.expr(f"cast(array() as array<{LEAK}>)")
    out = text_bytes(docs, *keep).withColumn("leaks", none).select(*keep, "leaks", "_bytes")
    for block in range(blocks):
        # about block_words words of the benchmark
        items = Items([(r[0], bytes(r[1])) for r in texts.filter(deal == block).orderBy("item_id", "text").collect()])
        if not items.vocab:
            continue
        items.choose(_counted(docs, items))
        shared = spark.sparkContext.broadcast(items)
        schema = T.StructType([*kept_fields, T.StructField("leaks", T._parse_datatype_string(f"array<{LEAK}>"))])
        leak_type = pa.list_(
            pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())])
        )
        last = block == blocks - 1

        def search(
            batches: Iterator[pa.RecordBatch], shared=shared, last=last, leak_type=leak_type
        ) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = shared.value.leaks(batch.column("_bytes").to_pylist())
                had = batch.column("leaks").to_pylist()
                leaks = pa.array([a + b for a, b in zip(had, found, strict=True)], leak_type)
                names = [c for c in batch.schema.names if c not in ("leaks", "_bytes")]
                rest = [] if last else [batch.column("_bytes")]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names), leaks, *rest], [*names, "leaks", *(["_bytes"] if rest else [])]
                )

        full = schema if last else T.StructType([*schema, T.StructField("_bytes", T.BinaryType())])
        out = out.mapInArrow(search, full)
    return out.select(*keep, "leaks")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and test item it leaks: doc_id, item_id, score, first_word, n_words."""
    found = screen(docs, benchmark).filter(F.size("leaks") > 0)
    return found.select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.*")

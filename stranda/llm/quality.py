"""Quality rules: base counts of every text and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed word n-grams (one and two words) are counted: the raw corpus over all
documents, the trusted target over documents that the labels call good. A document's score is the mean over
its n-grams of the logarithm of target to raw probability, so length does not matter. The threshold is
the same for every document: a low quantile of the trusted documents' scores less a margin, so what
scores like trusted text stays. A trusted document is scored, for the threshold and for its own verdict, by the
target without its own n-grams; so trusted and other documents are judged by counts of the same kind.

The number of buckets grows with the square root of the corpus, as the vocabulary of a language does
(``buckets_for``): 2^16 at 0.5 GB, 2^25 at 100 TB. Counts stay in a written table; ratios reach the workers in blocks of
``BLOCK`` buckets of four bytes, those of the target in blocks of 24. All documents that the labels call good are trusted: the target,
the threshold and what is judged without its own n-grams come from every one of them. Up to ``FEW`` doc_ids are broadcast, more are
joined by a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, small_batches, text_bytes, tidy
from .words import mix, windows, word_hashes

#: Least number of buckets, buckets for each unit of the square root of the corpus' bytes, and buckets of a block.
BUCKETS, GROWTH, BLOCK = 1 << 15, 2, 1 << 20
#: Largest number of trusted doc_ids that are broadcast.
FEW = 1 << 20
#: Quantile of trusted scores and the margin below it, in nats an n-gram, at which documents are still kept.
QUANTILE, MARGIN = 0.005, 0.01
#: Parts of a range of scores that are counted at once.
PARTS = 1 << 10
#: Added to each bucket's count.
SMOOTHING = 1.0

MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = 1
#: First bytes of characters that belong to words.
_CHAR = np.ones(256, np.int64)
_CHAR[0x80:0xC0] = 0
_CHAR[[0x20, *range(0x09, 0x0E)]] = 0


def _dup_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def base_counts(texts: list[bytes], hashes: np.ndarray, edges: np.ndarray) -> dict[str, np.ndarray]:
    """The columns ``COUNTS`` of a batch of texts."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    per_text = lambda table: np.diff(np.concatenate(([0], np.cumsum(table[buf])))[ends])
    window, first, owner = windows(hashes, edges, WINDOW)
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(window):
        own = window ^ mix(owner.astype(np.uint64) + np.uint64(1))
        order = np.argsort(own)
        same = own[order[1:]] == own[order[:-1]]
        repeated = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
        np.add.at(covered, first[repeated], 1)
        np.subtract.at(covered, first[repeated] + WINDOW, 1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(covered[:-1]) > 0)))
    return {
        "n_words": np.diff(edges),
        "word_chars": per_text(_CHAR),
        "n_symbols": per_text(_SYMBOL),
        "n_dup_lines": np.fromiter(map(_dup_lines, texts), np.int64, len(texts)),
        "n_repeat_words": np.diff(inside[edges]),
    }


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def _grams(hashes: np.ndarray, edges: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of each n-gram."""
    pairs, _, owner = windows(hashes, edges, 2)
    all_grams = np.concatenate((mix(hashes), pairs))
    owners = np.concatenate((np.repeat(np.arange(len(edges) - 1), np.diff(edges)), owner))
    return (all_grams % np.uint64(buckets)).astype(np.int64), owners


def buckets_for(docs: DataFrame) -> int:
    """A power of two that grows with the square root of the bytes of all texts."""
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    return 1 << max(BUCKETS.bit_length() - 1, math.ceil(math.log2(1 + GROWTH * math.sqrt(size))))


def gram_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """A row for each bucket that occurs: its raw n-grams and those of the target (``good``), over all documents.

    ``trusted`` (trusted_id) has distinct doc_ids, any number of them.
    """
    small_batches(docs.sparkSession)

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), np.int32)  # one task's n-grams
        for batch in batches:
            hashes, edges = word_hashes(batch.column("_bytes").to_pylist())
            grams, owner = _grams(hashes, edges, buckets)
            own = batch.column("_trusted").to_numpy(zero_copy_only=False)[owner]
            np.add.at(total[0], grams, np.int32(1))
            np.add.at(total[1], grams[own], np.int32(1))
        some = np.flatnonzero(total[0])
        for k in range(0, len(some), 1 << 16):
            part = some[k : k + (1 << 16)]
            columns = (part, *total[:, part].astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["bucket", "raw", "good"])

    rows = _flagged(docs, trusted, ()).mapInArrow(count, "bucket long, raw long, good long")
    return materialize(rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")), "grams")


@dataclass
class Ratios:
    """Log ratios by bucket, and what scoring a trusted document without its own n-grams needs of the target."""

    ratio: np.ndarray
    #: Buckets of the target in order, their counts and their raw probabilities.
    held: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    good: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    share: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def without_own(self, own: np.ndarray, bucket: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Log ratios of n-grams by the target without ``own`` of their bucket and ``total`` of all its n-grams."""
        prior = SMOOTHING * len(self.ratio)
        at = np.minimum(np.searchsorted(self.held, bucket), len(self.held) - 1)
        rest = np.maximum(0, self.good[at] - own) / self.share[at]
        return np.log(rest + prior) - np.log(np.maximum(0, self.good.sum() - total) + prior)


def log_ratio(raw: np.ndarray, good: np.ndarray) -> Ratios:
    """From counts by bucket. Every bucket of both multinomials is smoothed; all zero where there is no trusted text."""
    if not good.sum():
        return Ratios(np.zeros(len(raw), np.float32))
    prior = SMOOTHING * len(raw)
    share = (raw + SMOOTHING) / (raw.sum() + prior)
    held = np.flatnonzero(good)
    ratio = np.log(good / share + prior) - np.log(good.sum() + prior)
    return Ratios(ratio.astype(np.float32), held, good[held], share[held])


def gathered_ratios(counts: DataFrame, buckets: int) -> Ratios:
    """``log_ratio`` of a written table of counts, read a block of buckets at a time."""
    raw, good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for lo in range(0, buckets, BLOCK):
        rows = counts.filter((F.col("bucket") >= lo) & (F.col("bucket") < lo + BLOCK)).toArrow()  # at most BLOCK rows
        at = rows.column("bucket").to_numpy()
        raw[at], good[at] = rows.column("raw").to_numpy(), rows.column("good").to_numpy()
    return log_ratio(raw, good)


class Shared:
    """``Ratios`` sent to the workers in blocks, put together once in each."""

    def __init__(self, spark, ratios: Ratios):
        send = spark.sparkContext.broadcast
        self.blocks: list[Broadcast] = [send(ratios.ratio[k : k + BLOCK]) for k in range(0, len(ratios.ratio), BLOCK)]
        target = (ratios.held, ratios.good, ratios.share)
        self.target: list[Broadcast] = [send([x[k : k + BLOCK] for x in target]) for k in range(0, max(1, len(ratios.held)), BLOCK)]

    def ratios(self) -> Ratios:
        target = zip(*(b.value for b in self.target), strict=True)
        return Ratios(np.concatenate([b.value for b in self.blocks]), *map(np.concatenate, target))


def gram_scores(hashes: np.ndarray, edges: np.ndarray, ratios: Ratios, trusted: np.ndarray | None = None) -> np.ndarray:
    """Mean log ratio of each text; 0 for a text without words. ``trusted`` texts are part of the target's counts."""
    buckets, n = len(ratios.ratio), len(edges) - 1
    grams, owner = _grams(hashes, edges, buckets)
    value, total = ratios.ratio[grams].astype(np.float64), np.bincount(owner, minlength=n)
    if trusted is not None and len(ratios.held) and trusted.any():
        at = np.flatnonzero(trusted[owner])
        _, inverse, held = np.unique(owner[at] * buckets + grams[at], return_inverse=True, return_counts=True)
        value[at] = ratios.without_own(held[inverse], grams[at], total[owner[at]])
    return np.bincount(owner, value, n) / np.maximum(1, total)


def _few(trusted: DataFrame) -> bool:
    return trusted.count() <= FEW


def _flagged(docs: DataFrame, trusted: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The columns ``keep``, the text as ``_bytes`` and whether the row is ``_trusted``."""
    rows = docs.select(*keep, F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("_bytes"))

    def flagged(of: DataFrame, ids: DataFrame) -> DataFrame:
        found = of.join(ids, of["_id"] == ids["trusted_id"], "left")
        return found.select(*(of[k] for k in keep), "_bytes", F.col("trusted_id").isNotNull().alias("_trusted"))

    if _few(trusted):
        return flagged(rows, F.broadcast(trusted))
    # rows without an id stay where they are, so that they do not all meet in one task
    unknown = rows.filter("_id is null").select(*keep, "_bytes", F.lit(False).alias("_trusted"))
    return flagged(rows.filter("_id is not null"), trusted.hint("shuffle_hash")).unionByName(unknown)


def _scored(docs: DataFrame, trusted: DataFrame, shared: Shared, threshold: float | None, keep: tuple[str, ...]) -> DataFrame:
    small_batches(docs.sparkSession)
    kept_fields = [docs.schema[k] for k in keep]
    schema = T.StructType(
        [*kept_fields, *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("base_failed", T.BooleanType()),
         T.StructField("kept", T.BooleanType()), T.StructField("score", T.DoubleType())]
    )

    @tidy
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = shared.ratios()
        for batch in batches:
            texts = batch.column("_bytes").to_pylist()
            hashes, edges = word_hashes(texts)
            base = base_counts(texts, hashes, edges)
            failed = base_failed(base["n_words"], base["n_repeat_words"])
            value = gram_scores(hashes, edges, ratios, batch.column("_trusted").to_numpy(zero_copy_only=False))
            kept = ~failed & (value >= threshold) if threshold is not None else ~failed
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), *(pa.array(base[c], pa.int64()) for c in COUNTS), pa.array(failed), pa.array(kept), pa.array(value)],
                [*keep, *COUNTS, "base_failed", "kept", "score"],
            )

    return _flagged(docs, trusted, keep).mapInArrow(score, schema)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The distinct doc_ids that the labels call good and not toxic, as trusted_id."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return materialize(good.select(F.col("doc_id").cast("long").alias("trusted_id")).distinct(), "trusted")


def ranked_score(scores: DataFrame, rank: int) -> float:
    """The score of this rank from 0: the range is counted in PARTS parts, then the part that holds the rank, until it is one value."""
    low, high = scores.agg(F.min("score"), F.max("score")).head()
    while low < high:
        part = F.floor((F.col("score") - low) / (high - low) * PARTS)
        counted = scores.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
        for r in sorted(counted.collect()):  # at most PARTS + 1 rows
            if rank < r["n"]:
                break
            rank -= r["n"]
        low, high = r["low"], r["high"]
        scores = scores.filter(F.col("score").between(low, high))
    return low


def low_quantile(scores: DataFrame, share: float = QUANTILE) -> float | None:
    """The exact quantile of ``score`` (written) that ``percentile`` gives, without a task that holds all scores; null if there are none."""
    n = scores.count()
    if not n:
        return None
    at = share * (n - 1)
    below = math.floor(at)
    low, high = (ranked_score(scores, min(k, n - 1)) for k in (below, below + 1))
    return low if at == below or low == high else (below + 1 - at) * low + (at - below) * high


def fit(docs: DataFrame, trusted: DataFrame, buckets: int | None = None) -> tuple[Shared, float]:
    """Log ratios by bucket and the threshold. Where there is no trusted text all scores are 0."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    if trusted.isEmpty():
        return Shared(spark, Ratios(np.zeros(BUCKETS, np.float32))), 0.0
    buckets = buckets or buckets_for(docs)
    shared = Shared(spark, gathered_ratios(gram_counts(docs, trusted, buckets), buckets))
    ids = F.broadcast(trusted) if _few(trusted) else trusted
    own = docs.join(ids, F.col("doc_id").cast("long") == F.col("trusted_id"), "left_semi")
    low = low_quantile(materialize(_scored(own, trusted, shared, None, ("doc_id",)).filter("not base_failed").select("score"), "scores"))
    return shared, (low if low is not None else 0.0) - MARGIN


def quality_rules(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts, base rule and verdict of every row of ``docs`` (doc_id, text, ...), with the columns ``keep``.

    A null text has no words and fails the base rule, as does an empty one. Repeated rows get equal
    results, null doc_ids are judged by their text. Without trusted labels the base rule alone decides. An
    empty table gives no rows.
    """
    trusted = trusted_ids(labels)
    shared, threshold = fit(docs, trusted)
    return _scored(docs, trusted, shared, threshold, keep)

"""Seeded selection: non-overlapping rows by rank, limits by group, and even samples over contigs."""

from __future__ import annotations

import random
from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import AUTOSOMES
from ..sources.scratch import scratch_path, stored
from .ids import dense_pair_id
from .intervals import clear_of, with_islands


class Occupied:
    """Disjoint intervals of one contig in order, for overlap tests and insertion by binary search."""

    def __init__(self, spans: list[tuple[int, int]] | None = None):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans or []):
            self.add(start, end)

    def _range(self, start: int, end: int) -> tuple[int, int]:
        """Positions of the intervals that share a base with ``[start, end)``."""
        lo = bisect_left(self.ends, start + 1)
        return lo, max(lo, bisect_left(self.starts, end))

    def overlaps(self, start: int, end: int) -> bool:
        lo, hi = self._range(start, end)
        return lo < hi

    def add(self, start: int, end: int) -> None:
        lo, hi = self._range(start, end)
        if lo < hi:
            start, end = min(start, self.starts[lo]), max(end, self.ends[hi - 1])
        self.starts[lo:hi], self.ends[lo:hi] = [start], [end]


def hash_rank(seed: int, *keys: str) -> Column:
    """A pseudo-random order of rows that depends on their keys alone: the MD5 of the seed and the keys as text."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def seeded_shuffle(rows: DataFrame, seed: int, *keys: str, by: str = "category", name: str = "rank") -> DataFrame:
    """``rows`` with their place from 0 in a pseudo-random order of each ``by``, which depends on seed and keys alone. Keys tell rows apart.

    Rows are ordered and counted in ranges, so neither the driver nor one task sees a whole group.
    """
    counts = {r[by]: r["count"] for r in rows.filter(F.col(by).isNotNull()).groupBy(by).count().collect()}  # a row for each group
    hashed = rows.filter(F.col(by).isNotNull()).withColumn("_hash", hash_rank(seed, *keys))
    return _numbered(hashed, by, ["_hash", *keys], counts, name).drop("_hash")


def exact_shuffle_order(spark: SparkSession, sizes: list[int], seed: int) -> DataFrame:
    """(pool, ordinal, rank): where one seeded generator's successive shuffles put the rows of each pool.

    The standard library's generator is serial by nature; this holds one number for each row on the driver and is
    meant for reproducing published selections.
    """
    rng, out = random.Random(seed), []
    for pool, n in enumerate(sizes):
        order = list(range(n))
        rng.shuffle(order)
        out += [(pool, ordinal, rank) for rank, ordinal in enumerate(order)]
    return spark.createDataFrame(out, "pool int, ordinal long, rank long")


#: Rows of one category that are decided together at first, and the longest run of overlapping rows that is decided in one place.
BATCH, ISLAND = 1 << 16, 1 << 12


def _decided(batch: DataFrame, pos: str) -> DataFrame:
    """One row for each island of overlapping rows of ``batch``: its size, and what is kept of it by ascending ``pos``.

    Within an island a row is kept if it overlaps none that was kept before it: a fold over the island's rows in order.
    Islands of more than ISLAND rows are not decided.
    """
    rows = batch.select("chrom", "start", "end", pos)
    islands = with_islands(rows, ["chrom"]).groupBy("chrom", "_island").agg(F.sort_array(F.collect_list(F.struct(pos, "start", "end"))).alias("rows"))
    none = F.array().cast(f"array<struct<{pos}:bigint,start:bigint,end:bigint>>")
    clear = lambda kept, x: ~F.exists(kept, lambda k: (k["start"] < x["end"]) & (x["start"] < k["end"]))
    fold = F.aggregate("rows", none, lambda kept, x: F.when(clear(kept, x), F.array_append(kept, x)).otherwise(kept))
    return islands.select("chrom", F.size("rows").alias("n"), F.when(F.size("rows") <= ISLAND, fold).otherwise(none).alias("kept"))


def greedy_nonoverlap(rows: DataFrame, order: list[str], limit: int = 0, rank: str | Sequence[str] = "rank") -> DataFrame:
    """Rows (chrom, start, end, category, columns of ``rank``, ...) that overlap nothing kept before them.

    Categories come one after the other in ``order``, rows of a category by rank; ``limit`` keeps the first rows of
    each category (0: all). Empty intervals and categories that ``order`` lacks go. Ranks are unique in a category.

    A category is decided in batches of its order: what overlaps rows kept before goes by a join, and the rest falls into
    islands of overlapping rows that are independent of each other. Batches double while islands stay small. Under a random rank
    they do, since the batch before has thinned every crowded place; a batch with a large island is cut to a fourth.
    A step has the same plan whatever the number of categories, and a category ends once its limit is met.
    """
    spark, columns = rows.sparkSession, rows.columns
    place = F.array_position(F.array(*map(F.lit, order)), F.col("category")) - 1 if order else F.lit(-1)
    listed = rows.withColumn("_category", place.cast("int")).filter("_category >= 0 and end > start and chrom is not null")
    numbered = stored(dense_pair_id(listed, "_category", *([rank] if isinstance(rank, str) else rank), name="_pos"), "ranked")
    spans = numbered.select("_pos", "chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    sizes = {r["_category"]: r["count"] for r in numbered.groupBy("_category").count().collect()}  # a row for each category
    paths: list[str] = []
    kept_schema = "chrom string, _pos long, start long, end long"
    end = 0
    for category in range(len(order)):
        low, end, taken = end, end + sizes.get(category, 0), 0
        size = min(BATCH, max(ISLAND, 4 * limit)) if limit else BATCH
        while low < end and not (limit and taken >= limit):
            batch = spans.filter(F.col("_pos").between(low, min(low + size, end) - 1))
            if paths:
                batch = clear_of(batch, ["_pos"], spark.read.schema(kept_schema).parquet(*paths))
            seen = Observation()
            decided = _decided(batch, "_pos").observe(seen, F.max("n").alias("largest"), F.coalesce(F.sum(F.size("kept")), F.lit(0)).alias("kept"))
            kept = decided.select("chrom", F.inline("kept"))
            path = scratch_path(spark, "kept")
            kept.write.parquet(path)
            if (seen.get["largest"] or 0) > ISLAND:
                size = max(1, size // 4)
                continue
            if limit and taken + seen.get["kept"] > limit:
                first = spark.read.schema(kept_schema).parquet(path).orderBy("_pos").limit(limit - taken)
                path = scratch_path(spark, "kept")
                first.write.parquet(path)
            taken += seen.get["kept"]
            paths.append(path)
            low, size = low + size, size * 2
    if not paths:
        return numbered.limit(0).select(*columns)
    return numbered.join(spark.read.schema(kept_schema).parquet(*paths).select("_pos"), "_pos", "left_semi").select(*columns)


def limit_per_category(rows: DataFrame, limit: int, *order: Column, by: str = "category") -> DataFrame:
    """The first ``limit`` rows of each category (0: all); the plan cuts within tasks before it shuffles."""
    if not limit:
        return rows
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= limit).drop("_rank")


def sample_per_contig(rows: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """At most ``n`` rows of each contig, by the hash of their keys."""
    return limit_per_category(rows, n, hash_rank(seed, *keys), *map(F.col, keys), by="chrom")


def _numbered(rows: DataFrame, by: str, order: Sequence[str], counts: dict[str, int], name: str) -> DataFrame:
    """``rows`` with their place from 0 among those of their ``by``, a column of few values with the given counts, in the order of ``order``."""
    first, before = [], 0
    for value in sorted(counts, key=lambda v: v.encode()):
        first += [F.lit(value), F.lit(before).cast("long")]
        before += counts[value]
    if not first:
        return rows.withColumn(name, F.lit(0).cast("long"))
    dense = dense_pair_id(rows, by, *order, name="_dense")
    return dense.withColumn(name, F.col("_dense") - F.element_at(F.create_map(*first), F.col(by))).drop("_dense")


def _contig_counts(rows: DataFrame) -> dict[str, int]:
    return {r["chrom"]: r["count"] for r in rows.filter("chrom is not null").groupBy("chrom").count().collect()}  # a row for each contig


def exact_sample_per_contig(rows: DataFrame, n: int, seed: int, *order: str) -> DataFrame:
    """``rows`` with ``place``: of each contig with more than ``n`` rows those that one seeded generator of the standard library samples.

    Rows of a contig are taken in the order of ``order``, which tells all of them apart. ``place`` counts from 0 in the order of the draws; a
    contig that has no more rows keeps them all in their order. The driver holds the drawn numbers: ``n`` a contig.
    """
    counts = _contig_counts(rows)
    numbered = _numbered(rows.filter("chrom is not null"), "chrom", order, counts, "ordinal")
    drawn = [(c, i, k) for c, size in counts.items() if n < size for k, i in enumerate(random.Random(seed).sample(range(size), n))]
    some = rows.sparkSession.createDataFrame(drawn, "chrom string, ordinal long, place long")
    large = [c for c, size in counts.items() if n < size]
    whole = numbered.filter(~F.col("chrom").isin(*large)).withColumn("place", F.col("ordinal").cast("long"))
    return numbered.join(some, ["chrom", "ordinal"]).select(*rows.columns, "place").unionByName(whole.select(*rows.columns, "place"))


def exact_even_draws(counts: dict[str, int], total: int, seed: int, contigs: Sequence[str] = AUTOSOMES) -> list[tuple[str, int]]:
    """(contig, ordinal) of ``total`` rows in the order in which one seeded NumPy generator draws them, contig by contig.

    Equal shares come first, the remainder goes to the first contigs. What contigs are short of is dealt in turn to those with rows left, which
    are then drawn from again, out of what they have left.
    """
    rng = np.random.default_rng(seed)
    share, extra = divmod(total, len(contigs))
    due = {c: share + (k < extra) for k, c in enumerate(contigs)}
    gone: dict[str, list[int]] = {c: [] for c in contigs}
    out: list[tuple[str, int]] = []
    while any(due.values()):
        short = 0
        for c in contigs:
            rest = counts.get(c, 0) - len(gone[c])
            take = min(due[c], rest)
            if take:
                # a draw is a place among the rows that are left: move it past the drawn ones before it
                earlier = np.sort(np.array(gone[c], np.int64))
                at = rng.choice(rest, size=take, replace=False)
                at = at + np.searchsorted(earlier - np.arange(len(earlier)), at, side="right")
                out += [(c, int(i)) for i in at]
                gone[c] += at.tolist()
            short += due[c] - take
            due[c] = 0
        able = [c for c in contigs if counts.get(c, 0) > len(gone[c])]
        if not short or not able:
            return out
        for k in range(short):
            due[able[k % len(able)]] += 1
    return out


def exact_even_sample(rows: DataFrame, total: int, seed: int, *order: str, contigs: Sequence[str] = AUTOSOMES) -> DataFrame:
    """``rows`` with ``place``: the sample of ``exact_even_draws``, rows of a contig taken in the order of ``order``. The driver holds ``total`` numbers."""
    own = rows.filter(F.col("chrom").isin(*contigs))
    counts = _contig_counts(own)
    drawn = [(c, i, k) for k, (c, i) in enumerate(exact_even_draws(counts, total, seed, contigs))]
    some = rows.sparkSession.createDataFrame(drawn, "chrom string, ordinal long, place long")
    return _numbered(own, "chrom", order, counts, "ordinal").join(some, ["chrom", "ordinal"]).select(*rows.columns, "place")


def even_quotas(counts: dict[str, int], total: int, contigs: tuple[str, ...] = AUTOSOMES) -> dict[str, int]:
    """Rows to take from each contig: equal shares, the remainder to the first, shortfalls dealt in turn to those with rows left."""
    base, extra = divmod(total, len(contigs))
    wanted = {c: base + (k < extra) for k, c in enumerate(contigs)}
    left, taken = {c: counts.get(c, 0) for c in contigs}, dict.fromkeys(contigs, 0)
    while any(wanted.values()):
        short = 0
        for c in contigs:
            n = min(wanted[c], left[c])
            taken[c] += n
            left[c] -= n
            short += wanted[c] - n
            wanted[c] = 0
        able = [c for c in contigs if left[c]]
        if not short or not able:
            break
        for k in range(short):
            wanted[able[k % len(able)]] += 1
    return taken


def even_sample(rows: DataFrame, total: int, *order: Column, contigs: tuple[str, ...] = AUTOSOMES) -> DataFrame:
    """``total`` rows spread evenly over ``contigs``, the first of each by ``order``."""
    own = rows.filter(F.col("chrom").isin(*contigs))
    counts = {r["chrom"]: r["count"] for r in own.groupBy("chrom").count().collect()}  # a row for each listed contig
    quotas = even_quotas(counts, total, contigs)
    quota = F.element_at(F.create_map(*[x for c, n in quotas.items() for x in (F.lit(c), F.lit(n))]), F.col("chrom"))
    ranked = own.withColumn("_rank", F.row_number().over(Window.partitionBy("chrom").orderBy(*order)))
    return ranked.filter(F.col("_rank") <= quota).drop("_rank")

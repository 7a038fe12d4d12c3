import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stranda.operators import selection
from stranda.operators.controls import dense_pair_id, free_space, random_controls, upstream_controls
from stranda.operators.selection import (
    Occupied,
    even_quotas,
    even_sample,
    exact_even_sample,
    exact_sample_per_contig,
    exact_shuffle_order,
    greedy_nonoverlap,
    seeded_shuffle,
)

SCHEMA = "chrom string, start long, end long, category string, category_ord int, ord long, rank long, strand string, name string"


def rows_of(n, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        s = rng.randrange(900)
        c = rng.randrange(3)
        out.append((f"c{rng.randrange(2)}", s, s + rng.randrange(0, 40), "xyz"[c], c, k, k, rng.choice("+-."), f"n{k}"))
    return out


def test_occupied():
    held = Occupied([(0, 10), (20, 30)])
    assert not held.overlaps(10, 20)
    assert held.overlaps(9, 10)
    held.add(5, 25)
    assert list(zip(held.starts, held.ends, strict=True)) == [(0, 30)]
    held.add(30, 40)
    assert len(held.starts) == 2


def sequential(rows, order, limit):
    """What one pass over all rows keeps."""
    kept = []
    for cat in order:
        n = 0
        for r in sorted((r for r in rows if r[3] == cat), key=lambda r: r[6]):
            if limit and n == limit:
                break
            if r[2] > r[1] and not any(t[0] == r[0] and t[1] < r[2] and r[1] < t[2] for t in kept):
                kept.append(r)
                n += 1
    return sorted(kept)


def test_greedy_is_sequential(spark):
    rows = rows_of(120)
    for limit in (0, 9):
        got = greedy_nonoverlap(spark.createDataFrame(rows, SCHEMA), list("xyz"), limit).collect()
        assert sorted(tuple(r) for r in got) == sequential(rows, "xyz", limit)


@pytest.mark.parametrize("limit", [0, 1, 12])
def test_greedy_in_batches(spark, monkeypatch, limit):
    """Ten categories, long and short rows, a crowded place, and batches and islands of a few rows."""
    monkeypatch.setattr(selection, "BATCH", 16)
    monkeypatch.setattr(selection, "ISLAND", 8)
    rng = random.Random(13)
    out = []
    for k in range(700):
        s = 400 if k % 7 == 0 else rng.randrange(3000)
        c = rng.randrange(10)
        out.append([f"c{rng.randrange(3)}", s, s + rng.choice((0, 1, 5, 40, 300)), "abcdefghij"[c], c, k, None, rng.choice("+-."), f"n{k}"])
    for c in range(10):
        own = [r for r in out if r[4] == c]
        for rank, r in enumerate(rng.sample(own, len(own))):
            r[6] = rank * 3 + 7  # any unique numbers
    out = [tuple(r) for r in out]
    order = rng.sample("abcdefghi", 9)  # one category is not asked for
    got = greedy_nonoverlap(spark.createDataFrame(out, SCHEMA), order, limit).collect()
    assert sorted(tuple(r) for r in got) == sequential(out, order, limit)


def test_greedy_edges(spark):
    assert greedy_nonoverlap(spark.createDataFrame([], SCHEMA), list("xyz")).collect() == []
    rows = spark.createDataFrame(rows_of(20), SCHEMA)
    assert greedy_nonoverlap(rows, []).collect() == []
    assert greedy_nonoverlap(rows, ["no such"], 5).collect() == []
    nulls = spark.createDataFrame([(None, 1, 5, "x", 0, 0, 0, "+", "n"), ("c", None, 5, "x", 0, 1, 1, "+", "n"), ("c", 1, 5, "x", 0, 2, 2, None, None)], SCHEMA)
    assert [r.ord for r in greedy_nonoverlap(nulls.filter("chrom is not null"), ["x"]).collect()] == [2]


def test_upstream(spark):
    rows = rows_of(80, 2)
    df, n = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("c0", 950), ("c1", 950)], "chrom string, length long")
    anchors, flanks = upstream_controls(df, n, ["category_ord", "ord"], 50)
    want, number = {}, 0
    for r in sorted(rows, key=lambda r: (r[4], r[5])):
        size = r[2] - r[1]
        s, e = (r[2] + 50, r[2] + 50 + size) if r[7] == "-" else (r[1] - 50 - size, r[1] - 50)
        if s < 0 or e > 950 or any(o[3] == r[3] and o[0] == r[0] and o[1] < o[2] and s < e and o[1] < e and s < o[2] for o in rows):
            continue
        want[number] = (r[8], s, e)
        number += 1
    got = {r.pair_id: (r.name.removesuffix("_up"), r.start, r.end) for r in flanks.collect()}
    assert got == want
    assert {r.pair_id: r.name for r in anchors.collect()} == {k: v[0] for k, v in want.items()}
    assert all(r.name.endswith("_up") and r.category.endswith("_upstream") for r in flanks.collect())


def test_dense_ids(spark):
    df = spark.range(500).withColumn("k", F.expr("(id * 37) % 101"))
    got = dense_pair_id(df, "k", "id", ranges=7).orderBy("k", "id").collect()
    assert [r.pair_id for r in got] == list(range(500))


@pytest.mark.parametrize("exact", [False, True])
def test_random_controls(spark, exact):
    kept = greedy_nonoverlap(spark.createDataFrame(rows_of(60, 3), SCHEMA), list("xyz"))
    anchors = dense_pair_id(kept, "category_ord", "ord", ranges=2)
    n = spark.createDataFrame([("c0", 3000), ("c1", 3000)], "chrom string, length long")
    a, got = anchors.collect(), random_controls(anchors, n, 5, 200, exact).collect()
    again = random_controls(anchors, n, 5, 200, exact).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    clash = lambda x, y: x.chrom == y.chrom and x.start < y.end and y.start < x.end
    bare, plain = ([r for r in got if r.category.endswith(k)] for k in ("_random-noannot", "_random"))
    assert len(bare) + len(plain) == len(got) > 0
    assert not any(clash(x, y) for x in bare for y in a)
    assert not any(clash(x, y) for x in plain for y in a if x.category == f"{y.category}_random")
    for kind in (bare, plain):
        assert not any(clash(x, y) for i, x in enumerate(kind) for y in kind[:i])
    sizes = {r.pair_id: r.end - r.start for r in a}
    assert all(r.end - r.start == sizes[r.pair_id] and 0 <= r.start and r.end <= 3000 for r in got)


def test_random_places_are_uniform(spark):
    """Starts in two gaps of unlike size, against the rejection of draws from the whole contig."""
    fixed = [("c", 100, 400, "x", 0, 0, 0, "+", "n0"), ("c", 460, 1000, "x", 0, 1, 0, "+", "n1")]
    many = [(f"d{k}", 0, 40, "x", 0, k + 2, 0, "+", f"n{k + 2}") for k in range(600)]
    # contigs of one row each have the gaps [40, 100), [400, 460) and [1000, 1200) once the fixed rows lie on them too
    anchors = [(*r, i) for i, r in enumerate(many)]
    anchors += [(f"d{k}", s, e, "x", 0, 10_000 + 2 * k + j, 0, "+", "f", 10_000 + 2 * k + j) for k in range(600) for j, (_, s, e, *_) in enumerate(fixed)]
    n = spark.createDataFrame([(f"d{k}", 1200) for k in range(600)], "chrom string, length long")
    df = spark.createDataFrame(anchors, SCHEMA + ", pair_id long")
    got = [r.start for r in random_controls(df, n, 3, 400).filter("category = 'x_random-noannot' and pair_id < 600").collect()]
    rng, want = random.Random(1), []
    taken = [(0, 40), (100, 400), (460, 1000)]
    while len(want) < 6000:
        s = rng.randint(0, 1200 - 40)
        if not any(a < s + 40 and s < b for a, b in taken):
            want.append(s)
    share = lambda x, a, b: sum(a <= s < b for s in x) / len(x)
    assert len(got) > 590
    for a, b in ((40, 100), (400, 460), (1000, 1050), (1050, 1100), (1100, 1161)):
        assert abs(share(got, a, b) - share(want, a, b)) < 0.06


def test_free_space(spark):
    rows = [("k", "c", 5, 10), ("k", "c", 8, 20), ("k", "c", 30, 35), ("j", "c", 0, 50), ("j", "d", 10, 11), ("k", "d", 0, 1)]
    n = spark.createDataFrame([("c", 50), ("d", 12)], "chrom string, length long")
    got = free_space(spark.createDataFrame(rows, "key string, chrom string, start long, end long"), n, "key").collect()
    assert sorted(tuple(r) for r in got) == [
        ("j", "d", 0, 10, 0, 11), ("j", "d", 11, 12, 10, 11), ("k", "c", 0, 5, 0, 30), ("k", "c", 20, 30, 5, 30), ("k", "c", 35, 50, 15, 30), ("k", "d", 1, 12, 0, 11),
    ]


def test_no_room(spark):
    """Rows that nothing can take have no control, in either mode."""
    rows = [("c", 0, 60, "x", 0, 0, 0, "+", "a", 0), ("c", 70, 100, "x", 0, 1, 0, "+", "b", 1), ("c", 60, 70, "y", 1, 2, 0, "+", "d", 2)]
    n = spark.createDataFrame([("c", 100)], "chrom string, length long")
    df = spark.createDataFrame(rows, SCHEMA + ", pair_id long")
    for exact in (False, True):
        assert {(r.pair_id, r.category) for r in random_controls(df, n, 4, 50, exact).collect()} == {(2, "y_random")}


def test_too_long_region_raises(spark):
    df = spark.createDataFrame([("c", 0, 50, "x", 0, 0, 0, "+", "n", 0)], SCHEMA + ", pair_id long")
    n = spark.createDataFrame([("c", 20)], "chrom string, length long")
    with pytest.raises(Exception, match="longer than its contig"):
        random_controls(df, n).collect()


def test_exact_shuffle(spark):
    rng = random.Random(42)
    pools = [list(range(5)), list(range(8))]
    for p in pools:
        rng.shuffle(p)
    got = {(r.pool, r.rank): r.ordinal for r in exact_shuffle_order(spark, [5, 8], 42).collect()}
    assert [[got[k, i] for i in range(len(p))] for k, p in enumerate(pools)] == pools


def test_quotas(spark):
    contigs = tuple(f"chr{k}" for k in range(1, 23))
    full = even_quotas(dict.fromkeys(contigs, 1000), 2000)
    assert [full[c] for c in contigs] == [91] * 20 + [90] * 2
    short = even_quotas(dict.fromkeys(contigs, 1000) | {"chr1": 1, "chr2": 0}, 2000)
    assert sum(short.values()) == 2000
    assert short["chr1"] == 1
    assert max(short.values()) - min(v for c, v in short.items() if c not in ("chr1", "chr2")) <= 2
    assert even_quotas({"chr5": 3}, 100)["chr5"] == 3
    df = spark.createDataFrame([(f"chr{1 + k % 3}", k) for k in range(30)], "chrom string, k long")
    assert even_sample(df, 9, F.col("k"), contigs=("chr1", "chr2", "chr3")).groupBy("chrom").count().filter("count = 3").count() == 3


def test_exact_contig_sample(spark):
    """What the standard library samples of each contig's list, in its order."""
    rng = random.Random(2)
    rows = [(f"chr{1 + k % 4}", k, rng.random()) for k in range(90) if k % 4 < 3 or k < 20]
    got = exact_sample_per_contig(spark.createDataFrame(rng.sample(rows, len(rows)), "chrom string, k long, x double"), 7, 42, "k").collect()
    for chrom in ("chr1", "chr2", "chr3", "chr4"):
        own = [r for r in rows if r[0] == chrom]
        want = random.Random(42).sample(own, 7) if len(own) > 7 else own
        assert [(r.chrom, r.k, r.x) for r in sorted((r for r in got if r.chrom == chrom), key=lambda r: r.place)] == want
    assert exact_sample_per_contig(spark.createDataFrame([], "chrom string, k long"), 7, 42, "k").collect() == []


@pytest.mark.parametrize("total", [0, 5, 40, 300])
def test_exact_even_sample(spark, total):
    """Draws from lists that shrink, with shares that contigs are short of."""
    contigs = ("chr1", "chr2", "chr3", "chr10")
    sizes = {"chr1": 3, "chr2": 40, "chr10": 90, "chrX": 9}
    rows = [(c, k) for c, n in sizes.items() for k in range(n)]
    generator, want = np.random.default_rng(7), []
    left = {c: list(range(sizes.get(c, 0))) for c in contigs}
    base, extra = divmod(total, 4)
    due = [base + (k < extra) for k in range(4)]
    while any(due):
        carry = 0
        for k, c in enumerate(contigs):
            n = min(due[k], len(left[c]))
            if n:
                chosen = generator.choice(np.array(left[c]), size=n, replace=False).tolist()
                want += [(c, x) for x in chosen]
                left[c] = [x for x in left[c] if x not in chosen]
            carry, due[k] = carry + due[k] - n, 0
        able = [k for k, c in enumerate(contigs) if left[c]]
        if not carry or not able:
            break
        for k in range(carry):
            due[able[k % len(able)]] += 1
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "chrom string, k long")
    got = sorted(exact_even_sample(df, total, 7, "k", contigs=contigs).collect(), key=lambda r: r.place)
    assert [(r.chrom, r.k) for r in got] == want
    assert [r.place for r in got] == list(range(min(total, 133)))


def test_seeded_shuffle(spark):
    rows = [("abc"[k % 3], k) for k in range(50)] + [(None, 99)]
    df = spark.createDataFrame(rows, "category string, k long")
    got = {(r.category, r.rank): r.k for r in seeded_shuffle(df, 5, "k").collect()}
    for c in "abc":
        own = [k for x, k in rows if x == c]
        assert [got[c, i] for i in range(len(own))] == sorted(own, key=lambda k: hashlib.md5(f"5|{k}".encode()).hexdigest())
    assert len(got) == 50
    assert {(r.category, r.rank): r.k for r in seeded_shuffle(df, 6, "k").collect()} != got
    assert seeded_shuffle(df.limit(0), 5, "k").collect() == []

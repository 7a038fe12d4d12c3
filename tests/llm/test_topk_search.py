import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from stranda.llm import topk_search as ts

SCHEMA = "vec_id long, embedding array<float>"
narrow = lambda x: struct.unpack("f", struct.pack("f", x))[0]


def whole(v):
    if not v or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * narrow(x)) for x in v]


def brute(rows, every, k=5):
    """Every query against every row, one pair at a time."""
    rows = [(i, whole(v)) for i, v in rows]
    rows = [(i, v) for i, v in rows if i is not None and v is not None]
    out = []
    for i, q in {(i, tuple(v)) for i, v in rows if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in rows if j != i and len(v) == len(q))
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def search(spark, rows, every, k=5):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as v", "1 as block", "2 as score", "3 as copies", "4 as `a.b`", "5 as rank")
    return sorted(tuple(r) for r in ts.top_k(df, F.col("vec_id") % every == 0, k).collect())


def vectors(n, width, seed, spread=0.125):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(width)]) for i in range(n)]


def test_against_brute_force(spark):
    rows = vectors(700, 24, 1)
    rng = random.Random(2)
    # near copies, exact copies under many ids, repeated rows, ties
    rows += [(1000 + i, [x + rng.gauss(0, 0.02) for x in rows[50][1]]) for i in range(40)]
    rows += [(2000 + i, rows[20][1]) for i in range(300)]
    rows += [rows[40]] * 9 + [rows[33]] * 3
    rows += [(3000 + i, [0.5] * 12 + [-0.5] * 12) for i in range(12)]
    assert search(spark, rows, 20) == brute(rows, 20)


def test_odd_rows(spark):
    v = [0.25, -0.5, 0.0]
    rows = [(0, v), (1, None), (2, []), (3, [0.1, None, 0.2]), (4, [math.nan, 0.0, 0.0]), (5, [math.inf, 0.0, 0.0]), (6, [-0.001, 0.0, -1e-9]), (7, [0.0, 0.0, 0.0])]
    rows += [(None, v), (10, v), (11, [1.0, 2.0]), (20, [3.0, 1.0]), (30, [100.0, -200.0, 4000.0]), (-10, [-4000.0, 4000.0, 4000.0]), (40, v), (40, [1.0, 1.0, 1.0]), (8, [5000.0, 0.0, 0.0])]
    kept = [(i, x) for i, x in rows if i != 8]
    assert search(spark, rows, 10) == brute(kept, 10)
    assert [r[0] for r in search(spark, rows, 10) if r[1] == 1].count(40) == 2


def test_fewer_than_k(spark):
    rows = vectors(4, 3, 5)
    assert search(spark, rows, 2) == brute(rows, 2)
    assert search(spark, rows[:1], 1) == []
    assert search(spark, [], 1) == []
    assert search(spark, rows, 1, k=1) == brute(rows, 1, k=1)


def test_cells(spark, monkeypatch):
    """Many blocks and groups of queries, so that queries meet their rows in several cells."""
    for name, value in (("BLOCK_ROWS", 37), ("CELL_BLOCKS", 3), ("CELL_QUERIES", 11), ("TILE", 4)):
        monkeypatch.setattr(ts, name, value)
    rows = vectors(400, 10, 7)
    assert search(spark, rows, 10) == brute(rows, 10)


@pytest.mark.parametrize("spread", [0.125, 20.0])
def test_stops_on_proof(spread):
    """A search that leaves postings unread returns what all scores return, in single and in double precision."""
    rng = np.random.default_rng(3)
    v = np.floor(256 * rng.normal(0, spread, (3000, 64))).astype(np.int32)
    v[:30] = v[2000] + rng.integers(-3, 4, (30, 64))
    ids = np.arange(3000)
    block = ts.Block(ts.build_block(0, ids, np.ones(3000), v))
    asked = ids[::40]
    best = ts.Best(len(asked), 5)
    share = ts.search_block(block, asked, v[asked], best, 5)
    assert share < 0.9
    for n, q in enumerate(asked):
        scores = v.astype(np.int64) @ v[q].astype(np.int64)
        order = [j for j in np.lexsort((ids, -scores)) if j != q][:5]
        assert best.found[n][1].tolist() == order
        assert best.found[n][0].tolist() == scores[order].tolist()


def test_index_holds_every_posting():
    rng = np.random.default_rng(4)
    v = rng.integers(-70, 70, (500, 8)).astype(np.int32)
    block = ts.Block(ts.build_block(3, np.arange(500), np.ones(500), v))
    back = np.zeros_like(v)
    for d, a, b in zip(block.dims, block.starts[:-1], block.starts[1:], strict=True):
        back[block.rows[a:b], d] = block.impacts[a:b]
    assert (back == v).all()
    assert (np.diff(block.bands) <= 0).all()
    assert (block.left[-1] <= 1e-300).all()

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stranda.operators.signal import exact_score_stats, exact_stats, round_score, score_stats
from stranda.plans.annotate import annotate, annotate_in_place
from stranda.schemas import DATASET, SCORES, STATISTICS, conform


def track(spark):
    rows = [("c", k, k + 1, ((k * 37) % 200 - 90) / 7) for k in range(40) if k % 9] + [("c", 50, 60, 1.25), ("c", 60, 62, float("nan")), ("c", 70, 90, -2.0)]
    return spark.createDataFrame(rows, "chrom string, start long, end long, value double"), rows


def dense(rows, s, e):
    out = np.zeros(e - s)
    for _, a, b, v in rows:
        lo, hi = max(a, s), min(b, e)
        if lo < hi:
            out[lo - s : hi - s] = v
    return np.round(out, 2).astype(np.float32)


SPANS = [("a", "c", 0, 40, "+"), ("b", "c", 5, 12, "-"), ("d", "c", 45, 75, "-"), ("e", "c", 200, 230, "+"), ("f", "c", 60, 62, "+"), ("g", "c", 7, 7, "+"), ("h", "c", 0, 95, ".")]


def reference(x):
    x = x[~np.isnan(x)]
    if not len(x):
        return [np.nan] * 6
    up, down = x[x > 0], x[x < 0]
    return [x.mean(), x.std(), len(up) / len(x), len(down) / len(x), up.mean() if len(up) else 0, down.mean() if len(down) else 0]


def test_stats(spark):
    t, rows = track(spark)
    spans = spark.createDataFrame(SPANS, "span_id string, chrom string, start long, end long, strand string")
    native = {r.span_id: r for r in score_stats(spans, t, bin_size=16).collect()}
    exact = {r.span_id: r for r in exact_score_stats(spans, t, bin_size=16).collect()}
    for i, _, s, e, strand in SPANS:
        x = dense(rows, s, e)
        assert np.allclose([native[i][k] for k in STATISTICS], reference(x), rtol=1e-4, atol=1e-6, equal_nan=True), i
        want = exact_stats(x[::-1] if strand == "-" else x)
        assert np.array_equal(np.array([exact[i][k] for k in STATISTICS], np.float32), want, equal_nan=True), i


def test_unit_vector():
    assert np.allclose(exact_stats(np.array([0, 1, -2, 1])), [0, np.sqrt(1.5), 0.5, 0.25, 1, -2])


def test_rounding(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (-0.125,), (0.575,), (-0.004,)], "x double")
    assert [r[0] for r in df.select(round_score(F.col("x"))).collect()] == [0.12, 0.38, -0.12, 0.57, 0.0]


def rows_for(spark):
    base = dict.fromkeys(DATASET.names)
    one = base | {"chrom": "c", "start": 10, "end": 30, "strand": "+", "scope": "full", "context_start": 0, "context_end": 60, "pool_start": 3, "pool_end": 9, "label": "a"}
    return conform(spark.createDataFrame([tuple(r[c] for c in DATASET.names) for r in (one, one | {"scope": "100bp", "strand": "-"}, one | {"label": "b"})], DATASET), DATASET)


def test_annotate(spark, tmp_path):
    t, rows = track(spark)
    lengths = spark.createDataFrame([("c", 95)], "chrom string, length long")
    data = rows_for(spark)
    out = annotate(data, t, lengths)
    assert out.columns == [*DATASET.names, *SCORES.names]
    got = out.collect()
    assert len(got) == 3
    for r in got:
        span = (51, 57) if r.scope == "100bp" else (10, 30)
        assert np.allclose([r[f"phylop_{k}"] for k in STATISTICS], reference(dense(rows, *span)), rtol=1e-4, atol=1e-6)
        assert np.allclose([r[f"phylop_context_{k}"] for k in STATISTICS], reference(dense(rows, 0, 95)), rtol=1e-4, atol=1e-6)
    with pytest.raises(ValueError, match="already has"):
        annotate(out, t, lengths)
    with pytest.raises(Exception, match="lacks contig"):
        annotate(data, t, lengths.limit(0)).collect()
    path = str(tmp_path / "d.parquet")
    data.write.parquet(path)
    assert len(annotate_in_place(spark, path, t, lengths, exact=True).columns) == 30
    assert spark.read.parquet(path).count() == 3


def test_running_sums(spark):
    """Long spans over many bins, records that overlap, lie across bins and hold odd values, against arrays."""
    rng = random.Random(5)
    rows = []
    for _ in range(300):
        s = rng.randrange(900)
        rows.append((rng.choice("cd"), s, s + rng.choice((0, 1, 1, 3, 70)), rng.choice((rng.uniform(-5, 5), rng.uniform(-5, 5), 0.0, float("nan"), float("inf"), None))))
    spans = [(f"s{k}", rng.choice("cde"), a, a + rng.choice((0, 1, 2, 15, 16, 400, 2000))) for k, a in enumerate(rng.randrange(-5, 950) for _ in range(80))]
    df = spark.createDataFrame(rows, "chrom string, start long, end long, value double")
    got = {r.span_id: tuple(r)[1:] for r in score_stats(spark.createDataFrame(spans, "span_id string, chrom string, start long, end long"), df, bin_size=16).collect()}
    for i, chrom, a, b in spans:
        inside = [(max(s, a), min(e, b), v) for c, s, e, v in rows if c == chrom and max(s, a) < min(e, b)]
        good = [(e - s, round(v, 2)) for s, e, v in inside if v is not None and np.isfinite(v)]
        n = b - a - sum(e - s for s, e, v in inside if v is None or not np.isfinite(v))
        if n <= 0:
            assert np.isnan(got[i]).all()
            continue
        total = lambda f: sum(w * f(x) for w, x in good)
        up, down = total(lambda x: x > 0), total(lambda x: x < 0)
        mean = total(lambda x: x) / n
        want = (mean, max(0, total(lambda x: x * x) / n - mean**2) ** 0.5, up / n, down / n, total(lambda x: max(x, 0)) / up if up else 0, total(lambda x: min(x, 0)) / down if down else 0)
        assert np.allclose(got[i], want, rtol=1e-9, atol=1e-7), i


def test_statistics_in_place_of_stopped_ones(spark, tmp_path):
    """A dataset whose replacement was stopped is found aside and annotated from there."""
    t, _ = track(spark)
    path = str(tmp_path / "d.parquet")
    rows_for(spark).write.parquet(f"{path}.aside")
    assert annotate_in_place(spark, path, t, spark.createDataFrame([("c", 95)], "chrom string, length long")).count() == 3
    assert not (tmp_path / "d.parquet.aside").exists()

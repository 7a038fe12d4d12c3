from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stranda.operators import intervals as iv
from stranda.operators.nearest import nearest_at_distance, nearest_in_list

SPAN = st.tuples(st.sampled_from(["c1", "c2"]), st.integers(0, 60), st.integers(0, 25)).map(lambda x: (x[0], x[1], x[1] + x[2]))
LONG = st.tuples(st.sampled_from(["c1", "c2"]), st.integers(0, 3000), st.sampled_from([0, 1, 3, 16, 17, 120, 900, 40_000])).map(lambda x: (x[0], x[1], x[1] + x[2]))
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SCHEMA = "chrom string, start long, end long"


def brute_merge(spans, touching):
    out = []
    for c, s, e in sorted(x for x in spans if x[2] > x[1]):
        if out and out[-1][0] == c and (s <= out[-1][2] if touching else s < out[-1][2]):
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([c, s, e])
    return sorted(map(tuple, out))


@FEW
@given(st.lists(SPAN, max_size=12), st.booleans(), st.sampled_from([7, 1000]))
def test_merge(spark, spans, touching, size):
    df = spark.createDataFrame(spans, SCHEMA)
    assert sorted(map(tuple, iv.merge_intervals(df, touching, size).collect())) == brute_merge(spans, touching)


@FEW
@given(st.lists(SPAN, max_size=10), st.lists(SPAN, max_size=10), st.sampled_from([4, 64]))
def test_overlaps(spark, left, right, size):
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    meet = lambda x, y: x[0] == y[0] and x[1] < y[2] and y[1] < x[2] and x[1] < x[2] and y[1] < y[2]
    got = sorted((r.a_chrom, r.a_start, r.a_end, r.b_start, r.b_end) for r in iv.overlap_pairs(a, b, size).collect())
    assert got == sorted((*x, *y[1:]) for x in left for y in right if meet(x, y))
    assert sorted(map(tuple, iv.overlap_semi(a, b, size).collect())) == sorted(x for x in left if any(meet(x, y) for y in right))
    assert sorted(map(tuple, iv.overlap_anti(a, b, size).collect())) == sorted(x for x in left if not any(meet(x, y) for y in right))


@FEW
@given(st.lists(LONG, max_size=9), st.lists(LONG, max_size=9))
def test_overlaps_of_all_levels(spark, left, right):
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    meet = lambda x, y: x[0] == y[0] and x[1] < y[2] and y[1] < x[2] and x[1] < x[2] and y[1] < y[2]
    got = sorted((r.a_chrom, r.a_start, r.a_end, r.b_start, r.b_end) for r in iv.overlap_pairs(a, b, 2).collect())
    assert got == sorted((*x, *y[1:]) for x in left for y in right if meet(x, y))
    sites = sorted({(c, s) for c, s, _ in left})
    whole = brute_merge(right, True)
    clear = [x for x in sites if not any(x[0] == c and s <= x[1] and x[1] + 3 <= e for c, s, e in whole)]
    found = iv.outside_intervals(spark.createDataFrame(sites or [("none", 0)], "chrom string, pos long"), b, 3, 2)
    assert sorted(map(tuple, found.collect())) == (clear if sites else [("none", 0)])


def test_an_interval_has_few_keys_however_long(spark):
    lengths = [1, 4096, 4097, 10**6, 248_956_422, 2**40]
    rows = spark.createDataFrame([("c", 4095, 4095 + n) for n in lengths], SCHEMA).select(*(F.col(c).alias(f"a_{c}") for c in ("chrom", "start", "end")))
    rows = rows.withColumn("_a_level", iv._level(F.col("a_start"), F.col("a_end"), iv.BIN))
    other = rows.withColumnsRenamed({c: c.replace("a_", "b_", 1) for c in rows.columns})
    assert rows.select("_a_level").distinct().count() >= 4
    keys = {r.a_end - 4095: r["count"] for r in iv._keyed(rows, "a", other, True, iv.BIN).groupBy("a_end").count().collect()}
    assert set(keys) == set(lengths) and max(keys.values()) <= iv.WIDER + 1 + 2 * iv.LEVELS


def test_overlaps_of_edge_rows(spark):
    """Rows with a null place or of no length meet nothing, repeated rows meet each by itself, other columns come along."""
    wide = SCHEMA + ", _level string"
    a = spark.createDataFrame([("c", 0, 9, "x"), ("c", 0, 9, "x"), ("c", None, 9, "n"), (None, 0, 9, "n"), ("c", 4, 4, "e")], wide)
    b = spark.createDataFrame([("c", 8, 10**9, "y"), ("c", 9, 10, "no")], wide)
    assert [(r.a__level, r.b__level) for r in iv.overlap_pairs(a, b).collect()] == [("x", "y")] * 2
    assert iv.overlap_pairs(a, b.limit(0)).count() == iv.overlap_pairs(a.limit(0), b).count() == 0
    assert sorted(r._level for r in iv.overlap_anti(a, b).collect()) == ["e", "n", "n"]


def test_merge_rules(spark):
    df = spark.createDataFrame([("c", 0, 10), ("c", 10, 20)], SCHEMA)
    assert [tuple(r) for r in iv.merge_intervals(df).collect()] == [("c", 0, 20)]
    assert sorted(tuple(r) for r in iv.merge_intervals(df, False).collect()) == [("c", 0, 10), ("c", 10, 20)]
    df = df.union(spark.createDataFrame([("c", 5, 15)], SCHEMA))
    assert [tuple(r) for r in iv.merge_intervals(df, False).collect()] == [("c", 0, 20)]


def test_complement(spark):
    df = spark.createDataFrame([("c", 0, 5), ("c", 8, 10), ("d", 3, 20)], SCHEMA)
    n = spark.createDataFrame([("c", 12), ("d", 20), ("e", 9)], "chrom string, length long")
    assert sorted(tuple(r) for r in iv.complement(df, n).collect()) == [("c", 5, 8), ("c", 10, 12), ("d", 0, 3)]


def test_introns(spark):
    rows = [("t", 0, 10), ("t", 20, 50), ("t", 22, 30), ("t", 40, 60), ("u", 5, 9)]
    df = spark.createDataFrame(rows, "transcript_id string, start long, end long")
    assert sorted((r.start, r.end) for r in iv.introns(df).collect()) == [(10, 20), (30, 40)]


def test_outside_intervals(spark):
    sites = spark.createDataFrame([("c", p) for p in (0, 4, 5, 7, 8, 20)], "chrom string, pos long")
    spans = spark.createDataFrame([("c", 5, 8), ("c", 8, 10)], SCHEMA)
    assert sorted(r.pos for r in iv.outside_intervals(sites, spans).collect()) == [0, 4, 8, 20]


def test_nearest(spark):
    anchors = spark.createDataFrame([("c", 10000)], "chrom string, pos long")

    def near(*sites):
        s = spark.createDataFrame([("c", x) for x in sites], "chrom string, pos long")
        r = nearest_at_distance(anchors, s, 2000, 5000).head()
        return r.near_pos, r.near_delta

    assert near(8000, 12000) == (12000, 2000)
    assert near(8001, 11999) == (None, None)
    assert near(5000, 15001) == (5000, -5000)
    df = spark.createDataFrame([(10, [7, 13, 20]), (10, [])], "p long, v array<long>")
    got = [r[0] for r in df.select(nearest_in_list(F.col("p"), F.col("v"))).collect()]
    assert (tuple(got[0]), got[1]) == ((7, -3), None)


@FEW
@given(st.lists(st.integers(0, 80), max_size=8), st.integers(0, 80), st.integers(1, 12))
def test_nearest_brute(spark, sites, at, least):
    anchors = spark.createDataFrame([("c", at)], "chrom string, pos long")
    s = spark.createDataFrame([("c", x) for x in sites], "chrom string, pos long")
    r = nearest_at_distance(anchors, s, least).head()
    good = [x for x in sites if abs(x - at) >= least]
    want = min(good, key=lambda x: (abs(x - at), -x)) if good else None
    assert (r.near_pos, r.near_delta) == (want, None if want is None else want - at)


@FEW
@given(st.lists(st.tuples(st.sampled_from("cd"), st.integers(0, 400)), max_size=25), st.lists(st.tuples(st.sampled_from("cde"), st.integers(0, 400)), max_size=12), st.integers(0, 60), st.sampled_from([None, 90]))
def test_nearest_over_bins(spark, sites, anchors, least, most):
    """Bins of a few bases, so that most sites are carried over from another bin."""
    rows = [(c, p, k) for k, (c, p) in enumerate(anchors)] + [(None, 5, -1), ("c", None, -2)]
    a, s = spark.createDataFrame(rows, "chrom string, pos long, k long"), spark.createDataFrame(sites, "chrom string, pos long")
    got = {r.k: r.near_delta for r in nearest_at_distance(a, s, least, most, bin_size=16).collect()}
    want = {}
    for k, (c, p) in enumerate(anchors):
        deltas = [x - p for d, x in sites if d == c and abs(x - p) >= least and (most is None or abs(x - p) <= most)]
        want[k] = min(deltas, key=lambda d: (abs(d), -d), default=None)
    assert got == want

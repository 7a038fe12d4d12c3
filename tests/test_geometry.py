import pytest
from pyspark.sql import functions as F

from stranda.functions import geometry as g
from stranda.functions.hashing import stable_subspan
from stranda.functions.sequence import blocks_length, genomic_position, motif_positions, reverse_complement, spliced_sequence, trimmed_blocks
from stranda.operators.windows import context_windows, genome_lookup, tile_genome


def scalar_bounds(n, s, e, strand, length, policy):
    s, e = min(s, e), max(s, e)
    if policy == "symmetric":
        a = max(0, (s + e) // 2 - length // 2)
        b = min(n, a + length)
        return max(0, b - length), b
    w = min(1000, length) if e - s > length else length
    return (max(0, e - w), e) if strand == "+" else (s, min(n, s + w))


VECTORS = [
    (10000, 5000, 5100, "+", "causal", (3052, 5100)), (10000, 5000, 5100, "-", "causal", (5000, 7048)), (10000, 5000, 5100, "+", "symmetric", (4026, 6074)),
    (10000, 100, 200, "+", "causal", (0, 200)), (10000, 9900, 9950, "-", "causal", (9900, 10000)), (10000, 5000, 5100, ".", "causal", (5000, 7048)),
    (10000, 4000, 7000, "+", "causal", (6000, 7000)), (10000, 4000, 7000, "-", "causal", (4000, 5000)), (10000, 5000, 7048, "+", "causal", (5000, 7048)),
    (10000, 100, 200, "+", "symmetric", (0, 2048)), (10000, 9900, 9950, "+", "symmetric", (7952, 10000)), (900, 100, 200, "+", "symmetric", (0, 900)),
]


def test_context_bounds_vectors(spark):
    for policy in ("causal", "symmetric"):
        rows = [v for v in VECTORS if v[4] == policy]
        df = spark.createDataFrame([v[:4] for v in rows], "n long, s long, e long, strand string")
        a, b = g.context_bounds(F.col("n"), F.col("s"), F.col("e"), F.col("strand"), policy=policy)
        got = [tuple(r) for r in df.select(a, b).collect()]
        assert got == [v[5] for v in rows]


def test_context_bounds_against_scalar(spark):
    rows = [(10000, (k * 7919) % 9000, (k * 7919) % 9000 + (k * 31) % 4000 - 500, "+-."[k % 3]) for k in range(600)]
    df = spark.createDataFrame(rows, "n long, s long, e long, strand string")
    for policy in ("causal", "symmetric"):
        a, b = g.context_bounds(F.col("n"), F.col("s"), F.col("e"), F.col("strand"), policy=policy)
        assert [tuple(r) for r in df.select(a, b).collect()] == [scalar_bounds(*r, 2048, policy) for r in rows]
    with pytest.raises(ValueError, match="unknown context policy"):
        g.context_bounds(F.col("n"), F.col("s"), F.col("e"), F.col("strand"), policy="other")


def test_window_offsets_by_strand(spark):
    seq = "ACGTN" * 2000
    tiles = tile_genome(spark.createDataFrame([("c", seq)], "chrom string, seq string"))
    rows = [("c", 5000, 5100, "."), ("c", 5000, 5100, "-"), ("c", 9900, 9950, "-"), ("c", 4000, 7000, "+"), ("c", 5100, 5000, "."), ("c", 7, 7, "+"), ("x", 1, 9, "+")]
    regions = spark.createDataFrame(rows, "chrom string, start long, end long, strand string")
    got = {(r.start, r.strand): r for r in context_windows(regions, tiles, "causal").collect()}
    assert len(got) == 5
    assert (got[5000, "."].roi_start, got[5000, "."].roi_end, got[5000, "."].sequence) == (0, 100, seq[5000:7048])
    assert (got[5100, "."].roi_start, got[5100, "."].roi_end) == (0, 100)
    minus = got[5000, "-"]
    turned = seq[5000:7048].translate(str.maketrans("ACGT", "TGCA"))[::-1]
    assert (minus.roi_start, minus.roi_end, minus.sequence) == (1948, 2048, turned)
    assert (got[9900, "-"].roi_start, got[9900, "-"].roi_end) == (50, 100)
    assert (got[4000, "+"].roi_start, got[4000, "+"].roi_end, got[4000, "+"].context_start) == (0, 1000, 6000)


def test_lookup_across_tiles(spark):
    seq = "".join("ACGT"[(k * k + k // 7) % 4] for k in range(5000))
    tiles = tile_genome(spark.createDataFrame([("c", seq)], "chrom string, seq string"), 64, 31)
    rows = spark.createDataFrame([("c", k, k + 32) for k in range(0, 4960, 13)], "chrom string, a long, b long")
    assert all(r.sequence == seq[r.a : r.b] for r in genome_lookup(rows, tiles, "a", "b", 64).collect())


def test_spans(spark):
    one = spark.range(1)
    lit = F.lit
    assert tuple(one.select(*g.oriented_pool_span(lit("-"), lit(0), lit(1200), lit(100), lit(200))).head()) == (1000, 1100)
    roi = g.baseline_roi_span(lit("full"), lit(10000), lit(4000), lit(7000), lit("+"), lit(0), lit(0), lit(0), lit(0))
    assert tuple(one.select(*roi).head()) == (4476, 6524)
    with pytest.raises(Exception, match="unsupported scope"):
        one.select(*g.baseline_roi_span(lit("half"), lit(10000), lit(1), lit(2), lit("+"), lit(0), lit(0), lit(0), lit(0))).collect()


def test_stable_subspan(spark):
    rows = [("repeats", "0", 0, 100), ("repeats", "0", 0, 300), ("exons", "17", 948, 2048), ("UCNE", "3", 0, 99)]
    df = spark.createDataFrame(rows, "c string, p string, s int, e int")
    got = [tuple(r) for r in df.select(*stable_subspan(F.col("c"), F.col("p"), F.col("s"), F.col("e"))).collect()]
    assert got == [(0, 100), (88, 188), (1733, 1833), (None, None)]
    native = df.select("s", "e", *stable_subspan(F.col("c"), F.col("p"), F.col("s"), F.col("e"), exact=False)).toDF("s", "e", "a", "b").collect()
    assert all(r.a is None or r.s <= r.a and r.b <= r.e and r.b - r.a == 100 for r in native)


def test_normalize_contig(spark):
    names = ["chr1", "1", "MT", "chrM", "2", "chrUn", "X"]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    assert [r[0] for r in df.select(g.normalize_contig(F.col("c"), ["chr1", "chrM", "2", "chrX"])).collect()] == ["chr1", "chr1", "chrM", "chrM", "2", "chrUn", "chrX"]
    assert [r[0] for r in df.select(g.normalize_contig(F.col("c"), ["1", "M"])).collect()] == ["1", "1", "M", "M", "2", "chrUn", "X"]


def test_sequences(spark):
    df = spark.createDataFrame([("ACGTNacgtnR",)], "s string")
    assert df.select(reverse_complement(F.col("s"))).head()[0] == "RnacgtNACGT"
    df = spark.createDataFrame([("ATGATGxATG",), ("ATG",), ("",), ("AATGG",), (None,)], "s string")
    assert [r[0] for r in df.select(motif_positions(F.col("s"))).collect()] == [[0, 3, 7], [0], [], [1], None]
    with pytest.raises(ValueError, match="overlap"):
        motif_positions(F.col("s"), "ATA")


def test_blocks(spark):
    # two exons, in transcript order ATGAAA and CCCGGG on the minus strand
    plus = "TTTCAT", "CCCGGG"
    seq = plus[1] + "NN" + plus[0]
    cds = [(0, 6, 0), (8, 14, 0)]
    df = spark.createDataFrame([(seq, cds, "-")], "seq string, cds array<struct<start:bigint,end:bigint,phase:int>>, strand string")
    blocks = trimmed_blocks(F.col("cds"), F.col("strand"))
    row = df.select(
        spliced_sequence(F.col("seq"), blocks, F.col("strand")), spliced_sequence(F.col("seq"), blocks, F.col("strand"), False),
        *(genomic_position(blocks, F.lit(k), F.col("strand")) for k in (0, 5, 6, 12)), blocks_length(blocks),
    ).head()
    assert tuple(row) == ("CCCGGGATGAAA", "ATGAAACCCGGG", 13, 8, 5, None, 12)
    df = spark.createDataFrame([([(10, 12, 2), (20, 30, 1)], "+"), ([(10, 12, 1), (20, 30, 2)], "-"), ([(10, 20, 3)], "+"), ([(10, 20, None)], "+")], "cds array<struct<start:bigint,end:bigint,phase:int>>, strand string")
    got = [[tuple(b) for b in r[0]] for r in df.select(trimmed_blocks(F.col("cds"), F.col("strand"))).collect()]
    assert got == [[(20, 30, 0)], [(20, 28, 0), (10, 12, 8)], [(10, 20, 0)], [(10, 20, 0)]]

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from stranda.functions.attributes import has_tag, parse_attributes
from stranda.operators.checks import CheckError, compare_trees, validate
from stranda.plans import codons, functional
from stranda.schemas import DATASET, START_CODON_DATASET
from stranda.sources import readers, writers
from stranda.sources.fasta import scan_fasta
from stranda.sources.writers import read_bed_partitions, split_gtf, write_bed_tree, write_dataset, write_tsv

KNOWN = ["chr1", "chr2", "chrX"]


def contig(seed, n=20_000):
    x, out = seed, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("ACGT"[x >> 29])
    return "".join(out)


def put(seq, at, piece):
    return seq[:at] + piece + seq[at + len(piece) :]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    d = tmp_path_factory.mktemp("data")
    one, two, x = contig(1), contig(2), contig(3)
    one = put(one, 5000, "ATGAAACCATGCATGTTT")
    two = put(two, 7000, "CATGTTTCATGGG"[:12] + "CAT")  # reads ATG on the minus strand from its end
    wrap = lambda s: "\n".join(s[k : k + 60] for k in range(0, len(s), 60))
    (d / "genome.fa").write_text(f">chr1 first > one\n{wrap(one)}\n>chr2\n{wrap(two.lower())}\n>chrX\n{wrap(x)}\n")
    (d / "gtfs").mkdir()
    attrs = lambda t, more="": f'gene_id "G{t}"; transcript_id "{t}"; transcript_type "protein_coding"; tag "basic"; {more}'
    tags = 'tag "Ensembl_canonical"; tag "MANE_Select";'
    line = lambda c, kind, s, e, strand, phase, a: "\t".join([c, "src", kind, str(s), str(e), ".", strand, phase, a])
    chr1 = [
        "# comment", "short\tline", line("chr1", "exon", 1, 99, "+", ".", attrs("EARLY", tags)),
        line("chr1", "transcript", 4901, 5300, "+", ".", attrs("T1", tags)), line("chr1", "exon", 4901, 5100, "+", ".", attrs("T1", tags)),
        line("chr1", "exon", 5201, 5300, "+", ".", attrs("T1", tags)), line("chr1", "CDS", 5001, 5018, "+", "0", attrs("T1", tags)),
        line("chr1", "transcript", 9001, 9100, "+", ".", attrs("T9")), line("chr1", "exon", 9001, 9100, "+", ".", attrs("T9")),
    ]
    (d / "gtfs" / "chr1.gtf").write_text("\n".join(chr1) + "\n")
    chr2 = [line("chr2", "transcript", 6901, 7015, "-", ".", attrs("T2", tags)), line("chr2", "exon", 6901, 7015, "-", ".", attrs("T2", tags)), line("chr2", "CDS", 7001, 7015, "-", "x", attrs("T2", tags))]
    with gzip.open(d / "gtfs" / "chr2.gtf.gz", "wt") as f:
        f.write("\n".join(chr2) + "\n")
    (d / "gtfs" / "other.gtf").write_text(chr1[3] + "\n")
    info = d / "region_info"
    info.mkdir()
    beds = [f"chr{1 + k % 2}\t{300 + 450 * k}\t{340 + 450 * k}\tb{k}\t1.5\t{'+-.'[k % 3]}" for k in range(40)]
    (info / "repeats_hg38.bed").write_text("\n".join(["#c", "1\t500\t480", "chr1\t9\t9", "a\tb", "chrZ\t1\t5", *beds]) + "\n")
    (info / "hg38_UCNE_coordinates.bed").write_text('chrX\t100\t150\tkeep\nchrX\t300\t350\tgone\nX\t600\t655\t"q""x"\n')
    (info / "ucne_paralogues.txt").write_text("# no\nfirst gone, other\n\nkeep\n")
    (info / "experiments.tsv").write_text("vista_id\tcoord\tstrand\nhs1\tchrX:2001-2100\t\nhs2\tX:4001-4100\t-\nhs3\t\t+\n")
    for name in ("promoters", "UCSC_5UTR_exons", "UCSC_3UTR_exons"):
        (info / f"{name}.bed").write_text("".join(f"chrX\t{k}\t{k + 30}\tn{k}\t0\t+\n" for k in range(6000 + len(name) * 40, 6000 + len(name) * 40 + 400, 50)))
    return d


def test_fasta(spark, root):
    got = {r.chrom: r.seq for r in scan_fasta(spark, str(root / "genome.fa")).collect()}
    assert sorted(got) == KNOWN
    assert all(len(s) == 20_000 for s in got.values())
    assert got["chr1"][5000:5006] == "ATGAAA"


def test_bed(spark, root):
    rows = readers.scan_bed(spark, str(root / "region_info/repeats_hg38.bed"), "repeats", KNOWN).orderBy("ord").collect()
    assert len(rows) == 41
    assert (rows[0].chrom, rows[0].start, rows[0].end, rows[0].name, rows[0].score, rows[0].strand) == ("chr1", 480, 500, "repeats", 0.0, ".")
    blocked = readers.scan_exclusion_list(spark, str(root / "region_info/ucne_paralogues.txt"))
    assert sorted(r.name for r in blocked.collect()) == ["gone", "other"]
    ucne = readers.scan_bed(spark, str(root / "region_info/hg38_UCNE_coordinates.bed"), "UCNE", KNOWN, blocked=blocked)
    assert sorted((r.chrom, r.start, r.name) for r in ucne.collect()) == [("chrX", 100, "keep"), ("chrX", 600, 'q"x')]


def test_coord_table(spark, root, tmp_path):
    rows = readers.scan_coord_table(spark, str(root / "region_info/experiments.tsv"), KNOWN).collect()
    assert sorted((r.chrom, r.start, r.end, r.name, r.strand) for r in rows) == [("chrX", 2000, 2100, "hs1", "."), ("chrX", 4000, 4100, "hs2", "-")]
    (tmp_path / "t.tsv").write_text("a\tb\n1\t2\n")
    with pytest.raises(ValueError, match="none of the columns"):
        readers.scan_coord_table(spark, str(tmp_path / "t.tsv"), KNOWN)


def test_gtf(spark, root, tmp_path):
    rows = readers.scan_gtf(spark, str(root / "gtfs"), KNOWN).collect()
    assert len(rows) == 10
    assert {r.source for r in rows} == {"chr1.gtf", "chr2.gtf.gz"}
    split_gtf(spark, str(root / "gtfs/chr1.gtf"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 7


def test_attributes(spark):
    df = spark.createDataFrame([('gene_id "a b"; level 2; tag "x"; tag "y";',), ("",), ("junk",)], "t string")
    got = df.select(parse_attributes(F.col("t")).alias("m"), has_tag(F.col("t"), "x").alias("x")).collect()
    assert got[0].m == {"gene_id": "a b", "level": "2", "tag": "y"}
    assert [r.x for r in got] == [True, False, False]
    assert (got[1].m, got[2].m) == ({}, {})


def test_tables(spark, tmp_path):
    (tmp_path / "r").write_text("\t".join(map(str, range(13))) + "\n")
    row = readers.scan_repeat_table(spark, str(tmp_path / "r")).head()
    assert tuple(row) == ("5", 6, 7, "10", 1.0, "11")
    gene = lambda n, strand, cs, ce: f"0\t{n}\tchr1\t{strand}\t100\t900\t{cs}\t{ce}\t2\t100,500,\t300,900,\n"
    (tmp_path / "g").write_text(gene("p", "+", 200, 600) + gene("m", "-", 200, 600) + gene("n", "+", 900, 900))
    utrs = sorted((r.name, r.start, r.end) for r in readers.derive_utr(readers.scan_gene_table(spark, str(tmp_path / "g"))).collect())
    assert utrs == [("m_utr3_0", 100, 200), ("m_utr5_1", 600, 900), ("n_utr5_0", 100, 300), ("n_utr5_1", 500, 900), ("p_utr3_1", 600, 900), ("p_utr5_0", 100, 200)]
    (tmp_path / "s.bedgraph").write_text("track x\nchr1\t0\t5\t1.5\n")
    assert tuple(readers.scan_signal(spark, str(tmp_path / "s.bedgraph")).head()) == ("chr1", 0, 5, 1.5)
    assert readers.verify_digest(spark, str(tmp_path / "r")).head().length == 29


def test_trees(spark, tmp_path):
    rows = spark.createDataFrame([("chr1", 5, 9, "a", 0.0, "+", "10", "x", 1), ("chr1", 1, 2, "b", 0.5, "-", "2", "x", 0), ("chr2", 1, 2, "c", 0.5, "-", "3", "x_up", 2)],
        "chrom string, start long, end long, name string, score double, strand string, pair_id string, category string, ord long")
    write_bed_tree(rows, str(tmp_path / "t"))
    back = read_bed_partitions(spark, str(tmp_path / "t")).collect()
    assert sorted((r.category, r.chrom, r.name, r.pair_id) for r in back) == [("x", "chr1", "a", "10"), ("x", "chr1", "b", "2"), ("x_up", "chr2", "c", "3")]
    for folder, text in (("repeats", "chr1\t1\t2\tn\t0.0\t+\t0\n"), ("repeats_upstream", "chr1\t5\t6\tn_up\t0.0\t+\t0\n"), ("other", "chr1\t5\t6\tn\t0.0\t+\t0\n")):
        (tmp_path / "u" / folder).mkdir(parents=True)
        (tmp_path / "u" / folder / "chr1.bed").write_text(text)
    (tmp_path / "u" / "repeats" / "chr9.bed").write_text("chr9\t1\t2\tn\t0.0\t+\t0\n")
    got = readers.scan_bed_tree(spark, str(tmp_path / "u"), ["repeats"], ["chr1"]).collect()
    assert sorted((r.category, r.role, r.start, r.pair_id) for r in got) == [("repeats", "feature", 1, "0"), ("repeats", "upstream", 5, "0")]
    a, b = (readers.verify_digest(spark, str(tmp_path / "u" / x / "chr1.bed")).withColumn("path", F.lit("same")) for x in ("repeats", "other"))
    assert compare_trees(a, a) == []
    assert compare_trees(a, b) == ["same: differs"]


def test_codon_table_round_trip(spark, tmp_path):
    names = readers.scan_codon_table.__doc__
    assert names
    cols = "chrom transcript_id gene_id strand label1_start_pos label2_noncoding_near_pos label2_delta_bp label3_noncoding_far_pos label3_delta_bp label4_same_inframe_met_pos label4_delta_bp label5_same_outframe_atg_pos label5_delta_bp".split()
    df = spark.createDataFrame([("chr1", "t", "g", "+", 5, None, None, 7, 2, 8, 3, 9, 4)], ", ".join(f"{c} {'string' if k < 4 else 'long'}" for k, c in enumerate(cols)))
    write_tsv(df, str(tmp_path / "t.tsv"))
    assert [tuple(r) for r in readers.scan_codon_table(spark, str(tmp_path / "t.tsv")).collect()] == [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("noncoding", [False, True])
def test_functional_pipeline(spark, root, tmp_path, noncoding):
    options = functional.Options(limit_per_category=15, attempts=100, include_noncoding=noncoding)
    counts = functional.run(spark, str(root), str(tmp_path / "regions"), str(tmp_path / "out"), options)
    assert len(counts) == 10
    assert counts["functional-upstream-causal"] == 2 * counts["functional-multiclass-full-causal"] > 0
    for name, n in counts.items():
        df = spark.read.parquet(str(tmp_path / "out" / f"{name}.parquet"))
        policy = "symmetric" if name.endswith("bidi") else "causal"
        if "multiclass" in name:
            scope = "100bp" if "100bp" in name else "full"
            assert validate(df, DATASET, "multiclass", policy, scope=scope, complete=False) == n
        else:
            control = name.removeprefix("functional-").removesuffix("-bidi").removesuffix("-causal")
            assert validate(df, DATASET, "binary", policy, control=control, complete=False) == n
    df = spark.read.parquet(str(tmp_path / "out" / "functional-upstream-causal.parquet"))
    with pytest.raises(CheckError, match="bad_policy"):
        validate(df, DATASET, "binary", "symmetric", control="upstream", complete=False)
    with pytest.raises(CheckError, match="repeated_keys"):
        validate(df.union(df), DATASET, "binary", "causal", control="upstream", complete=False)
    with pytest.raises(CheckError, match="instead of"):
        validate(df.drop("name"), DATASET, "binary")


def test_codon_pipeline(spark, root, tmp_path):
    genome = scan_fasta(spark, str(root / "genome.fa"))
    labels = codons.label_table(genome, readers.scan_gtf(spark, str(root / "gtfs"), KNOWN))
    table = labels.collect()
    by = {r.transcript_id: r for r in table}
    assert by["T1"].label1_start_pos == 5000
    assert (by["T1"].label5_same_outframe_atg_pos, by["T1"].label5_delta_bp) == (5008, 8)
    assert (by["T1"].label4_same_inframe_met_pos, by["T1"].label4_delta_bp) == (5012, 12)
    assert by["T2"].label1_start_pos == 7014
    assert 2000 <= abs(by["T1"].label2_delta_bp) <= 5000
    assert by["T1"].label3_noncoding_far_pos is None
    wide = spark.createDataFrame([r.asDict() | {"label3_noncoding_far_pos": 1000, "label3_delta_bp": -4000} for r in table if r.transcript_id == "T1"], labels.schema)
    rows = codons.dataset(wide, genome, "causal")
    assert validate(rows, START_CODON_DATASET, "codon", "causal") == 5
    assert {r.label_id: r.delta_bp for r in rows.collect()}[1] == 0
    assert write_dataset(rows, str(tmp_path / "d"), START_CODON_DATASET) == 5


def test_window_stream(spark, root, tmp_path):
    from stranda.streaming import window_stream

    schema = "chrom string, start long, end long, strand string, name string, category string, pair_id string"
    spark.createDataFrame([("chr1", 100, 200, "+", "n", "x", "0"), ("chr2", 50, 90, "-", "m", "x", "1")], schema).write.parquet(str(tmp_path / "in"))
    tiles = scan_fasta(spark, str(root / "genome.fa"))
    q = window_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), tiles, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


ROWS = [("chr1", 5, 2), ("chr1", 1, 0), ("chr2", 9, None)]


@pytest.mark.parametrize("stop", range(1, 5))
def test_a_stopped_replacement_leaves_a_dataset(spark, tmp_path, monkeypatch, stop):
    """Whatever step breaks, the old or the new dataset is whole, and the next run succeeds."""
    path, schema = str(tmp_path / "d"), "chrom string, start long, roi_start int"
    old, new = spark.createDataFrame(ROWS[:1], schema), spark.createDataFrame(ROWS, schema)
    assert write_dataset(old, path, DATASET) == 1
    steps = []

    def broken(name):
        act = getattr(writers.Store, name)

        def step(self, *paths):
            steps.append(name)
            if len(steps) == stop:
                raise OSError("stopped")
            act(self, *paths)

        return step

    with monkeypatch.context() as m:
        for name in ("delete", "rename"):
            m.setattr(writers.Store, name, broken(name))
        with pytest.raises(OSError, match="stopped"):
            write_dataset(new, path, DATASET)
    assert len(steps) == stop
    at = writers.standing(spark, path)
    assert spark.read.parquet(at).count() == (3 if stop == 4 else 1)
    # rows that come from the dataset itself
    assert write_dataset(spark.read.parquet(at).unionByName(spark.read.parquet(at)), path, DATASET) == (6 if stop == 4 else 2)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["d"]
    assert writers.standing(spark, path) == path


def test_files_in_order(spark, tmp_path):
    """Rows of files in the order of their names, not of their sizes, across splits of a file."""
    want = []
    for name, n in (("chr1", 40), ("chr10", 700), ("chr2", 3), ("chrX", 0)):
        rows = [(name, k, None if k % 5 == 0 else f"v {k}") for k in range(n)]
        want += rows
        (tmp_path / f"{name}.tsv").write_text("a\tb\tc\n" + "".join(f"{a}\t{b}\t{'' if c is None else c}\n" for a, b, c in rows))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k, v in zip(before, ("900b", "1b"), strict=True):
        spark.conf.set(k, v)
    try:
        df = readers.concat_files(spark, str(tmp_path), "a string, b long, c string")
        assert [tuple(r) for r in df.orderBy("place").collect()] == [(*r, k) for k, r in enumerate(want)]
        some = readers.concat_files(spark, [str(tmp_path / "chr2.tsv"), str(tmp_path / "chr1.tsv")], "a string, b long, c string")
        assert [r.a for r in some.orderBy("place").collect()] == ["chr1"] * 40 + ["chr2"] * 3
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_digests(spark, tmp_path):
    for name, data in (("a", b"ab"), ("b", b"x" * 5000)):
        (tmp_path / name).write_bytes(data)
    got = {r.path.rsplit("/", 1)[-1]: (r.length, r.sha256) for r in readers.verify_digest(spark, str(tmp_path)).collect()}
    assert got == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in (("a", b"ab"), ("b", b"x" * 5000))}


def test_exact_codon_plan(spark, root, tmp_path):
    """The plan repeats seeded samples: the rows of each contig in file order, sampled, put together by name, and sampled again."""
    counts = codons.run(spark, str(root), str(tmp_path / "src"), str(tmp_path / "out"), 2, 1, 42, contigs=("chr1", "chr2", "chrX"), exact=True)
    again = codons.run(spark, str(root), str(tmp_path / "src2"), str(tmp_path / "out2"), 2, 1, 42, contigs=("chr1", "chr2", "chrX"), exact=True)
    assert counts == again
    table = readers.scan_codon_table(spark, str(tmp_path / "src" / "all_contigs.tsv"), ordered=True).orderBy("place").collect()
    assert [r.transcript_id for r in table] == ["T1", "T2"]

"""Tiles from FASTA lines, and transcripts stitched from tiles, against whole strings."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from stranda.functions.sequence import spliced_sequence, trimmed_blocks
from stranda.operators.transcripts import codon_sites, spliced_transcripts
from stranda.operators.windows import tile_genome
from stranda.sources import fasta

PARTS = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in PARTS}
    for k, v in zip(PARTS, ("700b", "1b"), strict=True):
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cut(seqs, tile, overlap):
    return sorted((c, t, t * tile, len(x), x[t * tile : t * tile + tile + overlap]) for c, x in seqs.items() for t in range(max(1, -(-len(x) // tile))))


def tiles(spark, path, tile, overlap):
    return sorted(tuple(r) for r in fasta.scan_fasta(spark, path, tile, overlap).collect())


def records(seed, n=12):
    rng = random.Random(seed)
    out, text = {}, []
    for k in range(n):
        seq = "".join(rng.choice("ACGTacgtN") for _ in range(rng.choice((0, 1, 59, 60, 61, 400, 3000))))
        out[f"c{seed}.{k}"] = seq
        width = rng.choice((1, 7, 60, 100, 5000))
        body = [seq[a : a + width] for a in range(0, len(seq), width)]
        if rng.random() < 0.3:
            body.insert(rng.randrange(len(body) + 1), "")
        text.append("\n".join([f">c{seed}.{k}" + rng.choice(("", " more > of it", "\ttab >x")), *(rng.choice((" ", "")) + x + rng.choice(("\r", "", " ")) for x in body)]))
    return out, "\n".join(text) + rng.choice(("\n", ""))


@pytest.mark.parametrize("seed", range(3))
def test_fasta_lines(spark, small_splits, tmp_path, seed):
    """Records that cross many splits of several files, plain and compressed."""
    want = {}
    for k in range(2):
        seqs, text = records(10 * seed + k)
        (tmp_path / f"{k}.fa").write_text(text, newline="")
        want |= seqs
    seqs, text = records(10 * seed + 5, 4)
    with gzip.open(tmp_path / "z.fa.gz", "wt", newline="") as f:
        f.write("no header yet\n" + text)
    want |= seqs
    assert fasta.fasta_lines(spark, str(tmp_path)).select("source", "block").distinct().count() > 8
    for tile, overlap in ((64, 10), (1000, 0), (50, 120)):
        assert tiles(spark, str(tmp_path), tile, overlap) == cut(want, tile, overlap)


def test_long_line(spark, tmp_path, monkeypatch):
    """A sequence on one line is cut into pieces at once."""
    monkeypatch.setattr(fasta, "PIECE", 1000)
    seq = "".join(random.Random(4).choice("ACGT") for _ in range(12_345))
    (tmp_path / "a.fa").write_text(f">one\n{seq}\n>\nACGT\n>two\n")
    assert tiles(spark, str(tmp_path / "a.fa"), 512, 100) == cut({"one": seq, "two": ""}, 512, 100)
    assert fasta.fasta_lines(spark, str(tmp_path / "a.fa")).agg(F.max("n")).head()[0] == 1000


def test_name_given_twice(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">one\nAC\n>one x\nGT\n")
    with pytest.raises(Exception, match="a contig is given twice: one"):
        tiles(spark, str(tmp_path / "a.fa"), 8, 1)
    (tmp_path / "b.fa").write_text("")
    assert tiles(spark, str(tmp_path / "b.fa"), 8, 1) == []


def test_tiles_of_any_text(spark):
    seqs = {"a": "ACGT" * 100, "b": "", "c": "ACé" * 50 + "T"}
    df = spark.createDataFrame(list(seqs.items()), "chrom string, seq string")
    for tile, overlap in ((7, 3), (400, 5), (1000, 0)):
        assert sorted(tuple(r) for r in tile_genome(df, tile, overlap).collect()) == cut(seqs, tile, overlap)


def transcripts(spark, seqs, seed, n=60):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        chrom = rng.choice([*seqs, "elsewhere"])
        edges = sorted(rng.sample(range(len(seqs.get(chrom, "x" * 900)) + 60), 2 * rng.randint(1, 5)))
        blocks = [(a, b, rng.choice((0, 0, 1, 2, 7))) for a, b in zip(edges[::2], edges[1::2], strict=True)]
        out.append((chrom, f"t{k}", rng.choice("+-"), blocks))
    df = spark.createDataFrame(out, "chrom string, transcript_id string, strand string, cds array<struct<start:long,end:long,phase:int>>")
    return df.withColumn("blocks", trimmed_blocks(F.col("cds"), F.col("strand"))).drop("cds")


@pytest.mark.parametrize("compat", [True, False])
def test_spliced_from_tiles(spark, compat):
    rng = random.Random(6)
    seqs = {f"c{k}": "".join(rng.choice("ACGTacgtNR") for _ in range(900)) for k in range(4)}
    genome = spark.createDataFrame(list(seqs.items()), "chrom string, seq string")
    df = transcripts(spark, seqs, 7)
    want = df.join(genome, "chrom").select("transcript_id", F.upper(spliced_sequence(F.col("seq"), F.col("blocks"), F.col("strand"), compat)).alias("x"))
    want = {r.transcript_id: r.x for r in want.collect() if r.x}
    for tile in (16, 100, 5000):
        got = {r.transcript_id: r.spliced for r in spliced_transcripts(df, tile_genome(genome, tile, 0), compat, tile).collect() if r.spliced}
        assert got == want


@pytest.mark.parametrize("compat", [True, False])
def test_codon_sites_by_hand(spark, compat):
    """Position lists of transcripts of several blocks, one letter at a time."""
    rng = random.Random(9)
    seqs = {f"c{k}": "".join(rng.choice(("ATG", "CAT", "A", "C", "G", "T")) for _ in range(400)) for k in range(3)}
    genome = spark.createDataFrame(list(seqs.items()), "chrom string, seq string")
    df = transcripts(spark, seqs, 11, 300)
    turn = str.maketrans("ACGT", "TGCA")
    want = {}
    for r in df.collect():
        if r.chrom not in seqs:
            continue
        pieces = [seqs[r.chrom][b.start : b.end] for b in r.blocks]
        if r.strand == "+":
            text = "".join(pieces)
        else:
            text = "".join(pieces).translate(turn)[::-1] if compat else "".join(p.translate(turn)[::-1] for p in pieces)
        place = [p for b in r.blocks for p in (range(b.start, b.end) if r.strand == "+" else range(b.end - 1, b.start - 1, -1))]
        hits = [o for o in range(len(text)) if text[o : o + 3] == "ATG"]
        if hits[:1] == [0]:
            want[r.transcript_id] = (place[0], sorted(place[o] for o in hits if o and o % 3 == 0), sorted(place[o] for o in hits if o % 3))
    found = codon_sites(df, tile_genome(genome, 64, 2), compat, 64).collect()
    assert {r.transcript_id: (r.anchor, r.inframe, r.outframe) for r in found} == want
    assert len(want) > 10

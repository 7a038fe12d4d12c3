import os
import random
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from jobs import motif_pairs
from jobs.config import load
from jobs.queries import MOTIF_PAIRS_SQL, job1_motif_pairs
from stranda.operators.checks import CheckError
from stranda.schemas import DATASET

SF = "/root/testdata/sf0.001"
CONFIG = load(None, "motif_pairs.toml") | {"flank_distance": 20, "context_length": 64, "held_out_every": 3}
TURN = str.maketrans("ACGTN", "TGCAN")


def bases(text):
    return "".join(motif_pairs.BASES[ord(c) - 65] for c in text.upper() if "A" <= c <= "Z")


def brute(docs, config):
    """Every contig by itself, motifs by search, overlaps by comparison with all features."""
    found = []
    for doc_id, text in docs:
        if doc_id is None or not text:
            continue
        seq = bases("".join(c for c in text if c.isascii()))
        here = []
        for strand, motif in (("+", config["motif"]), ("-", config["motif"].translate(TURN)[::-1])):
            at, runs = seq.find(motif), []
            while at >= 0:
                if runs and at <= runs[-1][1]:
                    runs[-1][1] = at + len(motif)
                else:
                    runs.append([at, at + len(motif)])
                at = seq.find(motif, at + 1)
            here += [(s, e, strand) for s, e in runs]
        for s, e, strand in here:
            d = config["flank_distance"]
            a, b = (e + d, e + d + e - s) if strand == "-" else (s - d - (e - s), s - d)
            if a >= 0 and b <= len(seq) and not any(x < b and a < y for x, y, _ in here):
                found.append((f"doc{doc_id}", s, strand, e, a, b, seq))
    out = set()
    for pair, (chrom, s, strand, e, a, b, seq) in enumerate(sorted(found)):
        for label, lo, hi, suffix in (("feature", s, e, ""), ("upstream", a, b, "_up")):
            for policy in config["policies"]:
                n, w = len(seq), config["context_length"]
                if policy == "causal":
                    cs, ce = (max(0, hi - w), hi) if strand == "+" else (lo, min(n, lo + w))
                else:
                    first = max(0, (lo + hi) // 2 - w // 2)
                    ce = min(n, first + w)
                    cs = max(0, ce - w)
                piece, r = seq[cs:ce], (lo - cs, hi - cs)
                if strand == "-":
                    piece, r = piece.translate(TURN)[::-1], (ce - hi, ce - lo)
                split = "test" if int(chrom[3:]) % config["held_out_every"] == 0 else "train"
                out.add((split, piece, label, str(pair), config["category"], "full", policy, chrom, lo, hi, strand, cs, ce, *r, *r, f"{chrom}:{s}:{strand}{suffix}"))
    return out


def corpus(n=60):
    rng = random.Random(8)
    words = ["tata", "aattta", "hello", "DATA aaa", "tuttata", "q", "lorem ipsum", "TATAAATATAAA", "ééé", "zy", "the cat sat"]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))) for k in range(n)]
    return docs + [(100, None), (101, ""), (102, "1234"), (None, "TATAAA" * 20), (103, "x" * 70_000 + "TATAAA" + "x" * 300)]


def write(spark, path, docs):
    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'a' as chrom", "'b' as start", "'c' as split").write.parquet(path)


def rows(spark, out):
    df = motif_pairs.read(spark, out)
    assert df.columns == DATASET.names
    got = [tuple(r) for r in df.collect()]
    assert len(set(got)) == len(got)
    return set(got)


def test_against_brute_force(spark, tmp_path):
    source, out = str(tmp_path / "docs"), str(tmp_path / "out")
    write(spark, source, corpus())
    counts = motif_pairs.run(spark, source, out, CONFIG)
    want = brute(corpus(), CONFIG)
    assert rows(spark, out) == want
    assert sum(counts.values()) == len(want) > 400
    assert {"context_policy=causal", "context_policy=symmetric"} <= {p.name for p in Path(out).iterdir()}
    # a second run, and one of a single policy, leave the same
    assert motif_pairs.run(spark, source, out, CONFIG) == counts
    assert motif_pairs.run(spark, source, out, CONFIG | {"policies": ["causal"]}) == {k: n for k, n in counts.items() if k.startswith("causal")}
    assert rows(spark, out) == want


def test_refuses(spark, tmp_path, monkeypatch):
    source, out = str(tmp_path / "docs"), str(tmp_path / "out")
    write(spark, source, [(1, "a"), (1, "b")])
    with pytest.raises(ValueError, match="documents of one id: 1"):
        motif_pairs.run(spark, source, out, CONFIG)
    assert not os.path.exists(out)
    write(spark, f"{source}-2", corpus(10))
    monkeypatch.setattr(motif_pairs, "faults", lambda *_: ["3 rows: bad_roi"])
    with pytest.raises(CheckError):
        motif_pairs.run(spark, f"{source}-2", out, CONFIG)
    assert not os.path.exists(out)


def test_nothing_found(spark, tmp_path):
    source, out = str(tmp_path / "docs"), str(tmp_path / "out")
    write(spark, source, [(1, "zzz"), (2, None)])
    assert motif_pairs.run(spark, source, out, CONFIG) == {}
    assert rows(spark, out) == set()


@pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")
def test_query(spark):
    got = job1_motif_pairs(spark, SF)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(MOTIF_PAIRS_SQL)
    names = [c[0] for c in want.description]
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(want.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")
def test_command(spark, tmp_path):
    args = ["--documents", f"{SF}/documents.parquet", "--output", str(tmp_path / "out")]
    done = subprocess.run([sys.executable, "-m", "jobs.motif_pairs", *args], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "read 200 documents" in done.stderr
    assert rows(spark, str(tmp_path / "out")) == {tuple(r) for r in job1_motif_pairs(spark, SF).collect()}

"""FASTA files whose splits are taken in runs of lines."""

import random

from stranda.operators.windows import tile_genome
from stranda.sources import fasta


def test_records_go_on_over_runs_and_no_run_is_long(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    genome = {f"c{k}": "".join(rng.choices("ACGT", k=n)) for k, n in enumerate((0, 5, 700, 1, 93, 2_000))}
    text = "".join(f">{c} x\n" + "".join(s[k : k + 7] + "\n" for k in range(0, len(s), 7)) for c, s in genome.items())
    (tmp_path / "a.fa").write_text(text)
    monkeypatch.setattr(fasta, "RUN", 4)
    got = fasta.scan_fasta(spark, str(tmp_path / "a.fa"), 100, 20)
    want = tile_genome(spark.createDataFrame(list(genome.items()), "chrom string, seq string"), 100, 20)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    plan = fasta.line_index(fasta.fasta_lines(spark, str(tmp_path / "a.fa")))._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftright" in plan

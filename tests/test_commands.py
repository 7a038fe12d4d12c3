import shutil

import pytest

from stranda import commands
from stranda.schemas import DATASET, START_CODON_DATASET, with_scores
from stranda.sources.writers import write_dataset

from .test_bigwig import write_bigwig
from .test_sources import root  # noqa: F401

CONTIGS = ["chr1", "chr2", "chrX"]


def call(spark, *argv):
    args = commands.parser().parse_args([str(a) for a in argv])
    return args.run(spark, args)


@pytest.fixture(scope="module")
def built(spark, root, tmp_path_factory):  # noqa: F811
    d = tmp_path_factory.mktemp("built")
    assert call(spark, "regions", "--data", root, "--regions", d / "regions", "--output", d / "out", "--limit", 10, "--attempts", 100) == 0
    return d


def test_names():
    names = commands.dataset_names()
    assert len(names) == 12
    assert names["functional-random-noannot-bidi"] == {"kind": "binary", "policy": "symmetric", "control": "random-noannot"}


def test_regions_then_datasets(spark, root, built, tmp_path):  # noqa: F811
    """Datasets from the tree that is there equal those of the whole run."""
    assert call(spark, "regions", "--data", root, "--regions", built / "regions", "--output", tmp_path / "o", "--keep-regions") == 0
    for name in ("functional-upstream-causal", "functional-multiclass-100bp-bidi"):
        assert call(spark, "compare", built / "out" / f"{name}.parquet", tmp_path / "o" / f"{name}.parquet") == 0
    assert call(spark, "compare", built / "out" / "functional-upstream-causal.parquet", built / "out" / "functional-upstream-bidi.parquet") == 1


def test_scores(spark, root, built, tmp_path):  # noqa: F811
    track = tmp_path / "t.bedGraph"
    track.write_text("".join(f"{c}\t{k}\t{k + 10}\t{(k % 7) - 3}\n" for c in CONTIGS for k in range(0, 20_000, 10)))
    data = built / "out" / "functional-upstream-causal.parquet"
    with pytest.raises(ValueError, match="give the genome"):
        call(spark, "scores", data, "--track", track, "--output", tmp_path / "o")
    with pytest.raises(ValueError, match="one of both"):
        call(spark, "scores", data, "--track", track)
    assert call(spark, "scores", data, "--track", track, "--genome", root / "genome.fa", "--output", tmp_path / "o") == 0
    scored = spark.read.parquet(str(tmp_path / "o" / data.name))
    assert scored.columns == with_scores(DATASET).names
    assert scored.filter("phylop_mean is null").count() == 0 < scored.count()
    shutil.copytree(data, tmp_path / data.name)
    assert call(spark, "scores", tmp_path / data.name, "--track", track, "--genome", root / "genome.fa", "--in-place") == 0
    assert call(spark, "compare", tmp_path / data.name, tmp_path / "o" / data.name) == 0


def test_lengths_of_a_bigwig_file(spark, tmp_path):
    write_bigwig(tmp_path / "t.bw", {"chr1": 500, "chr2": 90}, [])
    assert dict(map(tuple, commands.track_lengths(spark, str(tmp_path / "t.bw"), None).collect())) == {"chr1": 500, "chr2": 90}


def test_verify(spark, built, caplog):
    """Ten datasets are right; those of start codons are not there."""
    with caplog.at_level("INFO", "stranda"):
        assert call(spark, "verify", "--root", built / "out", "--part") == 1
    text = [r.getMessage() for r in caplog.records]
    assert sum("nothing wrong" in t for t in text) == 10
    assert sum("not found" in t for t in text) == 2


def test_verify_names_what_is_wrong(spark, built, tmp_path, caplog):
    name = "functional-upstream-causal"
    rows = spark.read.parquet(str(built / "out" / f"{name}.parquet"))
    write_dataset(rows.union(rows), str(tmp_path / f"{name}.parquet"), DATASET)
    assert call(spark, "verify", "--root", tmp_path) == 1
    wrong = [r.getMessage() for r in caplog.records if r.getMessage().startswith(name)]
    assert len(wrong) == 1 and "repeated_keys" in wrong[0] and "noncoding_missing" in wrong[0]


def test_codons(spark, root, tmp_path):  # noqa: F811
    given = ("codons", "--data", root, "--tables", tmp_path / "s", "--contigs", *CONTIGS, "--examples", 2)
    assert call(spark, *given, "--output", tmp_path / "a") == 0
    assert call(spark, *given, "--output", tmp_path / "b", "--keep-tables") == 0
    one = spark.read.parquet(str(tmp_path / "a" / "atg-bidi.parquet"))
    assert one.columns == START_CODON_DATASET.names
    assert call(spark, "compare", tmp_path / "a" / "atg-bidi.parquet", tmp_path / "b" / "atg-bidi.parquet") == 0

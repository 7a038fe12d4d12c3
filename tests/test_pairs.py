import pytest

from stranda.operators import checks, pairs
from stranda.schemas import CODON_LABELS, DATASET, NONCODING, TEST_CONTIGS

SCHEMA = "category string, pair_id string, role string, chrom string, start long, end long, name string, strand string, ord long"


def frame(spark):
    rows, n = [], 0
    for pair in ("0", "1", "10", "2"):
        for role in ("feature", "upstream", "random", "random-noannot"):
            if (pair, role) != ("1", "random"):
                rows.append(("x", pair, role, "c", 10 * n, 10 * n + 5, f"{role}{pair}", "+", n))
                n += 1
    rows.append(("x", "0", "feature", "c", 999, 1000, "later", "+", n))
    return spark.createDataFrame(rows, SCHEMA)


def test_roles(spark):
    df = frame(spark)
    got = pairs.binary_rows(df, "random").collect()
    assert sorted((r.pair_id, r.label) for r in got) == sorted((p, r) for p in ("0", "10", "2") for r in ("feature", "random"))
    assert {r.name for r in got if r.pair_id == "0" and r.role == "feature"} == {"later"}
    assert sorted(r.pair_id for r in pairs.common_pairs(df).collect()) == ["0", "10", "2"]
    assert [r.label for r in pairs.multiclass_rows(df).collect()] == ["x"] * 3


def test_checks(spark):
    df = frame(spark).withColumnRenamed("role", "label")
    assert [(r.label, r.pair_id, r.n_rows) for r in checks.repeated_keys(df, "label", "pair_id").collect()] == [("feature", "0", 2)]
    wrong = checks.wrong_pairs(df.filter("label in ('feature', 'random')"), ["feature", "random"]).collect()
    assert sorted((r.pair_id, r.n_rows) for r in wrong) == [("0", 3), ("1", 1)]
    assert checks.distinct_values(df, "category") == ["x"]


NAMES = DATASET.names
GOOD = dict(zip(NAMES, ("train", "ACGTACGT", "feature", "0", "exons", "full", "causal", "chr1", 0, 8, "+", 0, 8, 1, 7, 2, 6, "n"), strict=True))


def dataset_of(spark, *rows):
    return spark.createDataFrame([tuple((GOOD | r)[c] for c in NAMES) for r in rows], DATASET)


def whole(control="random", category="exons"):
    """A pair on a train contig and on each held-out one, and one of the non-coding category."""
    places = [("train", "chr1"), *(("test", c) for c in TEST_CONTIGS)]
    pairs = [{"split": s, "chrom": c, "pair_id": str(k), "category": category} for k, (s, c) in enumerate(places)] + [{"pair_id": "9", "category": NONCODING}]
    return [p | {"label": label} for p in pairs for label in ("feature", control)]


def broken(df, *args, **more):
    rows = {r.assertion: r.violations for r in checks.assertions(df, *args, **more).collect()}
    assert rows.pop("n_rows") == df.count()
    return {k: v for k, v in rows.items() if v}


def test_assertions_on_pairs(spark):
    rows = whole()
    good = dataset_of(spark, *rows)
    assert broken(good, "binary", "causal", "random", expected=10) == {}
    assert checks.validate(good, DATASET, "binary", "causal", "random", expected=10) == 12
    assert broken(good, "binary", "symmetric", "upstream", expected=7) == {"bad_policy": 12, "pair_without_its_labels": 6, "rows_more_or_less": 3}
    planted = [
        *rows[:-2], {"split": "train", "chrom": "chr2", "pair_id": "1"}, {"sequence": "", "pair_id": "20"}, {"sequence": None, "pair_id": "20", "label": "random"},
        {"roi_start": 7, "pair_id": "21"}, {"pool_end": 9, "pair_id": "21", "label": "random"}, {"pool_start": 0, "pair_id": "22"}, {"split": "dev", "chrom": "chr4", "pair_id": "23"},
    ]
    found = broken(dataset_of(spark, *planted), "binary", "causal", "random")
    assert found == {
        "bad_length": 2, "bad_roi": 1, "bad_pool": 3, "pool_outside_roi": 3, "unknown_split": 1, "contig_in_wrong_split": 1, "repeated_keys": 1,
        "pair_without_its_labels": 3, "noncoding_missing": 1,
    }
    with pytest.raises(checks.CheckError, match="bad_length: 2"):
        checks.validate(dataset_of(spark, *planted), DATASET, "binary", "causal", "random")
    with pytest.raises(checks.CheckError, match="18 columns|instead of"):
        checks.validate(good.drop("name"), DATASET, "binary", "causal", "random")
    with pytest.raises(ValueError, match="needs its control"):
        checks.assertions(good, "binary")


def test_assertions_on_whole_datasets(spark):
    rows = whole()
    few = [r for r in rows if r.get("chrom", "chr1") in ("chr1", "chr3") and r["category"] != NONCODING]
    assert broken(dataset_of(spark, *few), "binary", "causal", "random") == {"held_out_contig_missing": 3, "noncoding_missing": 1}
    assert broken(dataset_of(spark, *few[:2]), "binary", "causal", "random") == {"split_missing": 1, "held_out_contig_missing": 4, "noncoding_missing": 1}
    assert broken(dataset_of(spark, *few[:2]), "binary", "causal", "random", complete=False) == {}
    none = dataset_of(spark)
    assert broken(none, "binary", "causal", "random", complete=False) == {}
    assert broken(none, "multiclass", "causal", scope="full", expected=4) == {"split_missing": 2, "held_out_contig_missing": 4, "noncoding_missing": 1, "rows_more_or_less": 4}


def test_assertions_on_classes(spark):
    own = {"label": "exons", "scope": "100bp", "roi_end": 150, "pool_start": 10, "pool_end": 110, "sequence": "A" * 150}
    assert broken(dataset_of(spark, own), "multiclass", "causal", scope="100bp", complete=False) == {}
    odd = dataset_of(spark, own, own | {"pair_id": "1", "label": "introns"}, own | {"pair_id": "2", "scope": None, "pool_end": 109}, own)
    assert broken(odd, "multiclass", "causal", scope="100bp", complete=False) == {"label_is_not_category": 1, "another_scope": 1, "pool_of_another_width": 1, "repeated_keys": 1}
    five = [{"category": "ATG", "scope": "roi", "split": "test", "label": c, "pair_id": p} for c in CODON_LABELS for p in "ab"]
    assert broken(dataset_of(spark, *five), "codon", "causal", expected=10) == {}
    assert broken(dataset_of(spark, *five[1:], five[1]), "codon", "causal") == {"repeated_keys": 1, "pair_without_its_labels": 2}

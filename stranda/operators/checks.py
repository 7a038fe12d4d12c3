"""Assertions on datasets: one aggregate pass for row conditions, one for each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CODON_LABELS, CONTEXT_LENGTH, CONTROLS, NONCODING, SCORES, TEST_CONTIGS

KEY = ("scope", "category", "label", "pair_id")


class CheckError(AssertionError):
    """What a dataset violates."""


def schema_differences(df: DataFrame, schema: T.StructType) -> list[str]:
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in schema]
    return [f"column {k}: {h} instead of {w}" for k, (h, w) in enumerate(zip(have, want, strict=False)) if h != w] + (
        [f"{len(have)} columns instead of {len(want)}"] if len(have) != len(want) else []
    )


def _broken(df: DataFrame, policy: str | None = None) -> dict[str, Column]:
    """Conditions on single rows that rows of ``df`` may break."""
    size = F.char_length("sequence")
    broken = {
        "bad_length": ~F.coalesce(size.between(1, CONTEXT_LENGTH), F.lit(False)),
        "bad_roi": ~F.coalesce((F.col("roi_start") >= 0) & (F.col("roi_start") < F.col("roi_end")), F.lit(False)),
        "bad_pool": ~F.coalesce((F.col("pool_start") >= 0) & (F.col("pool_start") < F.col("pool_end")) & (F.col("pool_end") <= size), F.lit(False)),
        "pool_outside_roi": ~F.coalesce((F.col("pool_start") >= F.col("roi_start")) & (F.col("pool_end") <= F.col("roi_end")), F.lit(False)),
    }
    if policy is not None:
        broken["bad_policy"] = ~F.coalesce(F.col("context_policy") == policy, F.lit(False))
    scores = [c for c in SCORES.names if c in df.columns]
    if scores:
        odd = F.lit(False)
        for c in scores:
            odd = odd | F.col(c).isNull() | F.isnan(c)
        broken["missing_scores"] = odd
    return broken


def row_violations(df: DataFrame, policy: str | None = None) -> DataFrame:
    """One row with the number of rows and how many break each condition on a single row."""
    return df.agg(F.count("*").alias("n_rows"), *(F.count_if(c).alias(k) for k, c in _broken(df, policy).items()))


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has, with their number of rows."""
    return df.groupBy(*(keys or KEY)).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def label_sets(df: DataFrame, *by: str) -> DataFrame:
    """Labels (ascending) and number of rows of each pair."""
    by = by or ("category", "pair_id")
    return df.groupBy(*by).agg(F.array_sort(F.collect_set("label")).alias("labels"), F.count("*").alias("n_rows"))


def wrong_pairs(df: DataFrame, labels: list[str], *by: str) -> DataFrame:
    """Pairs that do not have exactly these labels, each once."""
    want = F.array(*map(F.lit, sorted(labels)))
    return label_sets(df, *by).filter((F.col("labels") != want) | (F.col("n_rows") != len(labels)))


def distinct_values(df: DataFrame, column: str) -> list:
    """Distinct values of a column of few values, ascending."""
    return sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().collect())


def row_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"))


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side that the other has fewer of, with ``side``."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def compare_trees(a: DataFrame, b: DataFrame, first: int = 10) -> list[str]:
    """The first differences of two trees of files, each (path, sha256)."""
    joined = a.alias("a").join(b.alias("b"), F.col("a.path") == F.col("b.path"), "full")
    odd = joined.filter(~F.col("a.sha256").eqNullSafe(F.col("b.sha256")))
    kind = F.when(F.col("b.path").isNull(), "only in the first").when(F.col("a.path").isNull(), "only in the second").otherwise("differs")
    rows = odd.select(F.coalesce("a.path", "b.path").alias("path"), kind.alias("kind")).orderBy("path").limit(first).collect()
    return [f"{r['path']}: {r['kind']}" for r in rows]


def assertions(
    df: DataFrame, kind: str, policy: str | None = None, control: str | None = None, scope: str | None = None, expected: int | None = None,
    complete: bool = True,
) -> DataFrame:
    """(assertion, violations): a row for each assertion on a ``binary``, ``multiclass`` or ``codon`` dataset, broken or not, and ``n_rows``.

    One pass: rows are added up by pair, pairs are judged, and both are added up again. ``expected`` is the number of rows
    outside the non-coding category; the violation is the difference. ``complete`` asks for what a dataset of all contigs has: both
    splits, test rows on every held-out contig and no other, and the non-coding category.
    """
    if kind == "binary" and control not in CONTROLS:
        raise ValueError("a binary dataset needs its control")
    if kind not in ("binary", "multiclass", "codon"):
        raise ValueError(f"unknown kind {kind!r} of dataset")
    count = lambda c: F.count_if(F.coalesce(c, F.lit(True)))
    test = F.col("split") == "test"
    rows = {k: F.count_if(c) for k, c in _broken(df, policy).items()}
    if kind != "codon":
        rows["unknown_split"] = count(~F.col("split").isin("train", "test"))
        rows["contig_in_wrong_split"] = count(F.col("chrom").isin(*TEST_CONTIGS) != test)
    if kind == "multiclass":
        rows["label_is_not_category"] = count(~F.col("label").eqNullSafe(F.col("category")))
        rows["another_scope"] = count(~F.col("scope").eqNullSafe(F.lit(scope)))
        if scope == "100bp":
            rows["pool_of_another_width"] = count(F.col("pool_end") - F.col("pool_start") != 100)
    kept = {"n_rows": F.count("*"), "_canonical": F.count_if(~F.col("category").eqNullSafe(F.lit(NONCODING)))} | rows
    seen = {"_train": F.col("split") == "train", "_test": test, "_noncoding": F.col("category") == NONCODING}
    seen |= {f"_held_{c}": test & (F.col("chrom") == c) for c in TEST_CONTIGS}
    labels = {"binary": ["feature", control], "codon": list(CODON_LABELS)}.get(kind)
    # a pair has a few rows
    pairs = df.groupBy(*(["pair_id"] if kind == "codon" else ["category", "pair_id"])).agg(
        *(c.alias(k) for k, c in kept.items()), *(F.max(F.coalesce(c, F.lit(False))).alias(k) for k, c in seen.items()),
        F.collect_list(F.struct("scope", "category", "label")).alias("_keys"),
    )
    own = F.transform("_keys", lambda k: k["label"])
    repeated = F.size("_keys") - F.size(F.array_distinct("_keys"))
    total = {k: F.coalesce(F.sum(k), F.lit(0)) for k in kept} | {"repeated_keys": F.coalesce(F.sum(repeated), F.lit(0))}
    if labels:
        want = F.array(*map(F.lit, sorted(labels)))
        total["pair_without_its_labels"] = F.count_if(F.coalesce(F.array_sort(own) != want, F.lit(True)))
    found = pairs.agg(*(c.cast("long").alias(k) for k, c in total.items()), *(F.coalesce(F.max(k), F.lit(False)).alias(k) for k in seen))
    missing = lambda c: F.when(c, F.lit(0)).otherwise(F.lit(1)).cast("long")
    values = {k: F.col(k) for k in total if not k.startswith("_")}
    if complete and kind != "codon":
        values["split_missing"] = missing(F.col("_train")) + missing(F.col("_test"))
        values["held_out_contig_missing"] = sum((missing(F.col(f"_held_{c}")) for c in TEST_CONTIGS), F.lit(0).cast("long"))
        values["noncoding_missing"] = missing(F.col("_noncoding"))
    if expected is not None:
        values["rows_more_or_less"] = F.abs(F.col("_canonical") - F.lit(expected))
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("assertion"), v.cast("long").alias("violations")) for k, v in values.items())))
    return found.select(each.alias("x")).select("x.assertion", "x.violations")


def validate(
    df: DataFrame, schema: T.StructType, kind: str, policy: str | None = None, control: str | None = None, scope: str | None = None,
    expected: int | None = None, complete: bool = True,
) -> int:
    """The number of rows of a dataset that keeps its schema and all ``assertions``, or CheckError with all that is wrong."""
    wrong = schema_differences(df, schema)
    if wrong:
        raise CheckError("; ".join(wrong))
    found = {r["assertion"]: r["violations"] for r in assertions(df, kind, policy, control, scope, expected, complete).collect()}
    n = found.pop("n_rows")
    if wrong := [f"{k}: {v}" for k, v in found.items() if v]:
        raise CheckError("; ".join(wrong))
    return n

"""Roles of a pair side by side, and wide rows of positions as labelled rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import composite_key
from ..schemas import CODON_LABELS, CONTROLS, ROLES

#: Position and delta columns of the five labels, in their order. Fixed values.
LABEL_COLUMNS = (
    ("label1_start_pos", None),
    ("label2_noncoding_near_pos", "label2_delta_bp"),
    ("label3_noncoding_far_pos", "label3_delta_bp"),
    ("label4_same_inframe_met_pos", "label4_delta_bp"),
    ("label5_same_outframe_atg_pos", "label5_delta_bp"),
)
PLACE = ("chrom", "start", "end", "name", "strand")


def common_pairs(rows: DataFrame) -> DataFrame:
    """(category, pair_id) that have every role, in one aggregation. ``rows`` has (category, role, pair_id, ...)."""
    roles = F.collect_set(F.when(F.col("role").isin(*ROLES), F.col("role")))
    return rows.groupBy("category", F.col("pair_id").cast("string").alias("pair_id")).agg(F.size(roles).alias("_n")).filter(
        F.col("_n") == len(ROLES)
    ).drop("_n")


def role_rows(rows: DataFrame) -> DataFrame:
    """One row of each role for every pair that has all roles (of repeated ones the last by ``ord`` where there is one)."""
    keyed = rows.withColumn("pair_id", F.col("pair_id").cast("string"))
    last = F.col("ord") if "ord" in rows.columns else F.struct("chrom", "start", "end")
    one = keyed.groupBy("category", "pair_id", "role").agg(F.max_by(F.struct(*PLACE), last).alias("_r"))
    complete = one.groupBy("category", "pair_id").agg(
        F.count(F.when(F.col("role").isin(*ROLES), 1)).alias("_n"), F.collect_list(F.struct("role", "_r")).alias("_all")  # four rows at most
    ).filter(F.col("_n") == len(ROLES))
    return complete.select("category", "pair_id", F.explode("_all").alias("x")).select("category", "pair_id", "x.role", "x._r.*")


def binary_rows(rows: DataFrame, control: str) -> DataFrame:
    """Feature and ``control`` rows, with ``label``, of pairs that have all four roles."""
    if control not in CONTROLS:
        raise ValueError(f"unknown control {control!r}")
    return role_rows(rows).filter(F.col("role").isin("feature", control)).withColumn("label", F.col("role"))


def multiclass_rows(rows: DataFrame) -> DataFrame:
    """Feature rows of pairs that have all four roles, labelled by category."""
    return role_rows(rows).filter("role = 'feature'").withColumn("label", F.col("category"))


def complete_examples(wide: DataFrame) -> DataFrame:
    """Rows with all five positions."""
    return wide.na.drop(subset=[c for c, _ in LABEL_COLUMNS])


def label_rows(wide: DataFrame) -> DataFrame:
    """Five rows (label_id, label, start, end, delta_bp, pair_id, name, ...) of each wide row of positions."""
    stacked = F.array(
        *(
            F.struct(
                F.lit(k).cast("byte").alias("label_id"), F.lit(label).alias("label"), F.col(pos).cast("long").alias("start"),
                (F.col(delta) if delta else F.lit(0)).cast("long").alias("delta_bp"),
            )
            for k, (label, (pos, delta)) in enumerate(zip(CODON_LABELS, LABEL_COLUMNS, strict=True), 1)
        )
    )
    keyed = wide.select(
        "chrom", "transcript_id", "gene_id", "strand",
        composite_key(F.col("chrom"), F.col("transcript_id"), F.col("strand"), F.col(LABEL_COLUMNS[0][0])).alias("pair_id"),
        F.explode(stacked).alias("x"),
    )
    rows = keyed.select("chrom", "transcript_id", "gene_id", "strand", "pair_id", "x.*")
    return rows.withColumns(
        {"end": F.col("start") + 3, "name": F.concat("transcript_id", F.lit("_L"), F.col("label_id").cast("string"))}
    )


def intersect_keys(frames: list[DataFrame], *keys: str) -> DataFrame:
    """Distinct keys that every frame has."""
    return reduce(lambda a, b: a.intersect(b), (f.select(*keys) for f in frames)).distinct()


def union_distinct(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()

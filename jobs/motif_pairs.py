"""Feature and control windows around the motifs of a text table, as a dataset partitioned by policy and split.

    python -m jobs.motif_pairs --documents PATH --output PATH [--config FILE]

Every document is a contig: its letters are read as bases. Neighbouring occurrences of a motif on a strand make one
feature. A feature is paired with an upstream control of its own length that overlaps no feature, or is left out with it.
Both get strand-oriented windows for each policy. The rows are checked before anything is published; then the
partitions of this run's policies are overwritten, those of others are left alone. A second run gives the same rows.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stranda.functions.sequence import BASES, letters_as_bases, reverse_complement  # noqa: F401
from stranda.operators import checks
from stranda.operators.controls import upstream_controls
from stranda.operators.intervals import merge_intervals
from stranda.operators.windows import context_windows, contig_lengths, dataset_rows, motif_scan, tile_genome
from stranda.schemas import DATASET
from stranda.sources.scratch import scratch_path, stored

from .config import arguments, load

log = logging.getLogger("jobs.motif_pairs")

PARTITIONS = ("context_policy", "split")


def contigs(documents: DataFrame) -> DataFrame:
    """(chrom, seq): ``doc`` and the id, and the letters of the text as bases. Documents without id or letters go; an id given twice raises."""
    again = documents.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").limit(3).collect()
    if again:
        raise ValueError("documents of one id: " + ", ".join(str(r["doc_id"]) for r in again))
    named = documents.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("chrom"), letters_as_bases(F.col("text")).alias("seq"))
    return named.filter("chrom is not null and seq <> ''")


def features(tiles: DataFrame, motif: str, category: str) -> DataFrame:
    """(chrom, start, end, strand, name, category) of runs of a motif on either strand."""
    opposite = tiles.sparkSession.range(1).select(reverse_complement(F.lit(motif))).head()[0]
    strands = [("+", motif), ("-", opposite)] if opposite != motif else [(".", motif)]
    out = None
    for strand, found in strands:
        sites = motif_scan(tiles, found).select("chrom", F.col("pos").alias("start"), (F.col("pos") + len(found)).alias("end"))
        runs = merge_intervals(sites).withColumn("strand", F.lit(strand))
        out = runs if out is None else out.unionByName(runs)
    name = F.concat_ws(":", "chrom", F.col("start").cast("string"), "strand")
    return out.select("chrom", "start", "end", "strand", name.alias("name"), F.lit(category).alias("category"))


def faults(rows: DataFrame, policies: list[str]) -> list[str]:
    """What rows of the dataset violate."""
    found = checks.row_violations(rows).head().asDict()
    wrong = [f"{n} rows: {k}" for k, n in found.items() if k != "n_rows" and n]
    odd = checks.wrong_pairs(rows, ["feature", "upstream"], "context_policy", "pair_id").count()
    unknown = rows.filter(~F.col("context_policy").isin(*policies)).count()
    return wrong + [f"{n} {what}" for n, what in ((odd, "pairs without feature and control"), (unknown, "rows of another policy")) if n]


def run(spark: SparkSession, documents: str, output: str, config: dict) -> dict[str, int]:
    """Build the dataset from the table at ``documents`` in the folder ``output``; the number of rows of each partition."""
    table = spark.read.parquet(documents).select("doc_id", "text")
    # tiles and features are read by many steps; texts are read as bases once
    tiles = stored(tile_genome(contigs(table)), "tiles")
    found = stored(features(tiles, config["motif"], config["category"]), "features")
    anchors, controls = upstream_controls(found, contig_lengths(tiles), ["chrom", "start", "strand"], config["flank_distance"])
    both = anchors.withColumn("label", F.lit("feature")).unionByName(controls.withColumn("label", F.lit("upstream")))
    both = both.withColumn("category", F.lit(config["category"]))
    rows = None
    for policy in config["policies"]:
        framed = context_windows(both, tiles, policy, config["context_length"])
        of_policy = dataset_rows(framed, F.col("label"), F.lit("full"))
        rows = of_policy if rows is None else rows.unionByName(of_policy)
    held_out = F.substr("chrom", F.lit(4)).cast("long") % config["held_out_every"] == 0
    rows = rows.withColumn("split", F.when(held_out, "test").otherwise("train"))
    # checked where nobody reads it; the windows are cut once
    staged = scratch_path(spark, "motif-pairs")
    rows.write.parquet(staged)
    rows = spark.read.schema(DATASET).parquet(staged)
    log.info("read %d documents from %s", table.count(), documents)
    if wrong := faults(rows, config["policies"]):
        raise checks.CheckError("; ".join(wrong))
    # rebalancing splits large partitions over tasks and keeps small ones in one file
    rows.hint("rebalance", *PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(
        *PARTITIONS
    ).parquet(output)
    counts = {f"{r['context_policy']}/{r['split']}": r["n_rows"] for r in checks.row_counts(rows, *PARTITIONS).collect()}
    log.info("wrote %s to %s", ", ".join(f"{n} rows of {k}" for k, n in sorted(counts.items())) or "nothing", output)
    return counts


def read(spark: SparkSession, output: str) -> DataFrame:
    """The dataset as it stands, in the order of its schema."""
    return spark.read.schema(DATASET).parquet(output).select(*DATASET.names)


def main() -> None:
    from stranda.session import session

    args = arguments("Feature and control windows around motifs", documents="Parquet table (doc_id, text)", output="folder of the dataset")
    spark = session("motif-pairs")
    try:
        run(spark, args.documents, args.output, load(args.config, "motif_pairs.toml"))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

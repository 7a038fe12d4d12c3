"""Start codons and four contrasts of each transcript, as five labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.intervals import outside_intervals
from ..operators.nearest import nearest_at_distance, nearest_in_list
from ..operators.pairs import complete_examples, label_rows
from ..operators.selection import even_sample, exact_even_sample, exact_sample_per_contig, hash_rank, sample_per_contig
from ..operators.transcripts import coding_spans, coding_transcripts, codon_sites
from ..operators.windows import context_windows, contig_lengths, motif_scan
from ..schemas import AUTOSOMES, POLICIES, START_CODON_DATASET, conform, with_scores
from ..sources import readers
from ..sources.fasta import scan_fasta
from ..sources.scratch import stored
from ..sources.writers import write_dataset, write_tsv
from .annotate import annotate

NEAR, FAR = (2000, 5000), (100_000, None)


def label_table(tiles: DataFrame, gtf: DataFrame, per_contig: int = 10_000, seed: int = 42, compat: bool = True, exact: bool = False) -> DataFrame:
    """Wide rows of positions: the start, the nearest ATG outside coding sequence at two distances, and the
    nearest in and out of frame. ``exact`` samples as published and sorts the rows by contig and place in the sample."""
    transcripts = coding_transcripts(gtf)
    contigs = transcripts.select("chrom").distinct()
    background = outside_intervals(motif_scan(tiles.join(contigs, "chrom", "left_semi")), coding_spans(transcripts))
    sites = codon_sites(transcripts, tiles, compat)
    if exact:
        # transcripts stand in the order of their first coding line
        sites = exact_sample_per_contig(sites, per_contig or 1 << 40, seed, "line_no", "transcript_id")
    elif per_contig:
        sites = sample_per_contig(sites, per_contig, seed, "transcript_id", "anchor")
    place = F.col("place") if exact else F.lit(0).cast("long")
    kept = sites.select("chrom", "transcript_id", "gene_id", "strand", "anchor", "inframe", "outframe", place.alias("place"))
    near = nearest_at_distance(kept, background, *NEAR, at="anchor", name="near")
    both = nearest_at_distance(near, background, *FAR, at="anchor", name="far")
    inside = both.withColumns(
        {"_in": nearest_in_list(F.col("anchor"), F.col("inframe")), "_out": nearest_in_list(F.col("anchor"), F.col("outframe"))}
    )
    inside = inside.orderBy("chrom", "place") if exact else inside
    return inside.select(
        "chrom", "transcript_id", "gene_id", "strand", F.col("anchor").alias("label1_start_pos"),
        F.col("near_pos").alias("label2_noncoding_near_pos"), F.col("near_delta").alias("label2_delta_bp"),
        F.col("far_pos").alias("label3_noncoding_far_pos"), F.col("far_delta").alias("label3_delta_bp"),
        F.col("_in.pos").alias("label4_same_inframe_met_pos"), F.col("_in.delta").alias("label4_delta_bp"),
        F.col("_out.pos").alias("label5_same_outframe_atg_pos"), F.col("_out.delta").alias("label5_delta_bp"),
    )


def sampled_examples(table: DataFrame, total: int = 2000, seed: int = 42, contigs: tuple[str, ...] = AUTOSOMES) -> DataFrame:
    return even_sample(complete_examples(table), total, hash_rank(seed, "chrom", "transcript_id"), F.col("transcript_id"), contigs=contigs)


def dataset(examples: DataFrame, tiles: DataFrame, policy: str) -> DataFrame:
    """Five rows for each example whose five windows all exist."""
    windows = context_windows(label_rows(examples), tiles, policy)
    five = windows.withColumn("_n", F.count("*").over(Window.partitionBy("pair_id"))).filter("_n = 5").drop("_n")
    typed = five.withColumns(
        {
            "split": F.lit("test"), "category": F.lit("ATG"), "scope": F.lit("roi"),
            "pool_start": F.col("roi_start"), "pool_end": F.col("roi_end"),
        }
    )
    return conform(typed, START_CODON_DATASET)


def run(
    spark: SparkSession, data_root: str, source_dir: str, output_dir: str, n_examples: int = 2000, per_contig: int = 10_000, seed: int = 42,
    track: DataFrame | None = None, skip_source: bool = False, contigs: tuple[str, ...] = AUTOSOMES, exact: bool = False,
) -> dict[str, int]:
    """Write the label tables and both datasets; the number of rows of each. ``exact`` repeats the published samples."""
    tiles = stored(scan_fasta(spark, f"{data_root}/genome.fa").filter(F.col("chrom").isin(*contigs)), "tiles")
    whole = f"{source_dir}/all_contigs.tsv"
    if not skip_source:
        gtf = readers.scan_gtf(spark, f"{data_root}/gtfs", list(contigs))
        write_tsv(label_table(tiles, gtf, per_contig, seed, exact=exact), whole)
    if exact:
        table = complete_examples(readers.scan_codon_table(spark, whole, ordered=True))
        drawn = exact_even_sample(table.withColumnRenamed("place", "_line"), n_examples, seed, "_line", contigs=contigs)
        examples = stored(drawn.drop("_line"), "examples").orderBy("place").drop("place")
    else:
        examples = stored(sampled_examples(readers.scan_codon_table(spark, whole), n_examples, seed, contigs), "examples")
    write_tsv(examples, f"{source_dir}/sampled_examples.tsv")
    lengths = contig_lengths(tiles)
    counts = {}
    for policy in POLICIES:
        name = f"atg-{ {'symmetric': 'bidi'}.get(policy, policy)}"
        rows = dataset(examples, tiles, policy)
        schema = START_CODON_DATASET if track is None else with_scores(START_CODON_DATASET)
        counts[name] = write_dataset(rows if track is None else annotate(rows, track, lengths), f"{output_dir}/{name}.parquet", schema)
    n = examples.count()
    if any(c != 5 * n for c in counts.values()):
        raise AssertionError(f"{n} examples gave {counts} rows")
    return counts

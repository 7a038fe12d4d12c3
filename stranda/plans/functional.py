"""Functional regions: sources to anchors, controls of three kinds, and fixed-schema datasets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import stable_subspan
from ..operators.controls import random_controls, upstream_controls
from ..operators.ids import dense_pair_id
from ..operators.intervals import complement
from ..operators.pairs import binary_rows, multiclass_rows
from ..operators.selection import exact_shuffle_order, greedy_nonoverlap, hash_rank
from ..operators.transcripts import annotated_spans, gene_features
from ..operators.windows import context_windows, contig_lengths, dataset_rows
from ..schemas import CATEGORIES, CONTROLS, DATASET, DATASET_CONTIGS, NONCODING, POLICIES, with_scores
from ..sources import readers
from ..sources.fasta import scan_fasta
from ..sources.scratch import stored
from ..sources.writers import write_bed_tree, write_dataset
from .annotate import annotate


@dataclass
class Options:
    """What the pipeline can be told; ``exact`` repeats published random choices at the price of serial steps."""

    limit_per_category: int = 10_000
    seed: int = 42
    include_noncoding: bool = False
    attempts: int = 2000
    exact: bool = False
    skip_scores: bool = True
    skip_regions: bool = False
    skip_datasets: bool = False
    policies: tuple[str, ...] = POLICIES
    contigs: tuple[str, ...] = field(default_factory=lambda: DATASET_CONTIGS)


def source_regions(spark: SparkSession, root: str, known: list[str], gtf: DataFrame) -> DataFrame:
    """All categories from the files below ``root``, each row with its place in its source."""
    info = f"{root}/region_info"
    blocked = readers.scan_exclusion_list(spark, f"{info}/ucne_paralogues.txt")
    tables = [
        readers.scan_bed(spark, f"{info}/repeats_hg38.bed", "repeats", known),
        readers.scan_bed(spark, f"{info}/hg38_UCNE_coordinates.bed", "UCNE", known, blocked=blocked),
        readers.scan_coord_table(spark, f"{info}/experiments.tsv", known),
        readers.scan_bed(spark, f"{info}/promoters.bed", "promoters", known),
        readers.scan_bed(spark, f"{info}/UCSC_5UTR_exons.bed", "UTR5", known),
        readers.scan_bed(spark, f"{info}/UCSC_3UTR_exons.bed", "UTR3", known),
    ]
    genes = gene_features(gtf).withColumn("_place", F.struct("source", "first_line", "part"))
    for t in tables:
        t_rows = t.select("chrom", "start", "end", "name", "score", "strand", "category", F.struct(F.lit("").alias("source"), F.col("ord").alias("first_line"), F.lit(0).cast("long").alias("part")).alias("_place"))
        genes = genes.unionByName(t_rows, allowMissingColumns=True)
    return genes.select("chrom", "start", "end", "name", "score", "strand", "category", "_place")


def noncoding_regions(gtf: DataFrame, lengths: DataFrame) -> DataFrame:
    """What canonical transcripts leave of the contigs they lie on, introns included."""
    gaps = complement(annotated_spans(gtf), lengths)
    place = F.struct(F.col("chrom").alias("source"), F.col("start").alias("first_line"), F.lit(0).cast("long").alias("part"))
    return gaps.select(
        "chrom", "start", "end", F.lit(NONCODING).alias("name"), F.lit(0.0).alias("score"), F.lit(".").alias("strand"), F.lit(NONCODING).alias("category"), place.alias("_place")
    )


def ranked(regions: DataFrame, order: list[str], seed: int, exact: bool) -> DataFrame:
    """``regions`` with category_ord and the rank in which a category's rows are considered."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("category").orderBy("_place", "chrom", "start", "end")) - 1
    numbered = regions.withColumn("category_ord", F.array_position(F.array(*map(F.lit, order)), F.col("category")).cast("int"))
    if not exact:
        dealt = numbered.withColumn("_h", hash_rank(seed, "category", "chrom", "start", "end", "strand", "name"))
        return dense_pair_id(dealt, "category_ord", "_h", "_place", "chrom", "start", "end", name="rank").drop("_h")
    rows = numbered.withColumn("ordinal", place.cast("long")).persist()
    sizes = {r["category"]: r["count"] for r in rows.groupBy("category").count().collect()}  # a row for each category
    shuffled = exact_shuffle_order(rows.sparkSession, [sizes.get(c, 0) for c in order], seed)
    pool = F.col("category_ord") - 1
    return rows.withColumn("pool", pool).join(shuffled, ["pool", "ordinal"]).drop("pool", "ordinal")


def select_anchors(regions: DataFrame, order: list[str], options: Options) -> DataFrame:
    kept = greedy_nonoverlap(ranked(regions, order, options.seed, options.exact).drop("_place"), order, options.limit_per_category)
    return kept.withColumn("ord", F.col("rank"))


def with_controls(anchors: DataFrame, lengths: DataFrame, options: Options) -> DataFrame:
    """Anchors and their controls as rows with ``role`` and the anchors' ``category``."""
    columns = ["chrom", "start", "end", "name", "score", "strand", "category", "category_ord", "ord"]
    own, upstream = upstream_controls(anchors.select(*columns), lengths, ["category_ord", "ord"])
    randoms = random_controls(own, lengths, options.seed, options.attempts, options.exact)
    plain = own.withColumn("role", F.lit("feature"))
    up = upstream.withColumns({"role": F.lit("upstream"), "category": F.regexp_replace("category", "_upstream$", ""), "score": F.lit(0.0)})
    drawn = randoms.withColumns(
        {
            "role": F.when(F.col("category").endswith("_random-noannot"), "random-noannot").otherwise("random"),
            "category": F.regexp_replace("category", "_random(-noannot)?$", ""), "score": F.lit(0.0),
        }
    )
    return plain.unionByName(up).unionByName(drawn)


def build_regions(spark: SparkSession, root: str, lengths: DataFrame, options: Options) -> DataFrame:
    """Rows of all roles and categories on the contigs of ``lengths`` (chrom, length).

    With the non-coding category, controls are made a second time on all anchors, and of that second run only the non-coding
    rows count; the other categories stay as they are without it.
    """
    known = [r["chrom"] for r in lengths.select("chrom").orderBy("chrom").collect()]  # contig names
    gtf = readers.scan_gtf(spark, f"{root}/gtfs", known)
    regions, order = source_regions(spark, root, known, gtf), list(CATEGORIES)
    if options.include_noncoding:
        regions, order = regions.unionByName(noncoding_regions(gtf, lengths)), [*order, NONCODING]
    anchors = select_anchors(regions, order, options).persist()
    if not options.include_noncoding:
        return with_controls(anchors, lengths, options)
    first = with_controls(anchors.filter(F.col("category") != NONCODING), lengths, options)
    return first.unionByName(with_controls(anchors, lengths, options).filter(F.col("category") == NONCODING))


def write_regions(rows: DataFrame, root: str) -> None:
    named = F.when(F.col("role") == "feature", F.col("category")).otherwise(F.concat_ws("_", "category", "role"))
    write_bed_tree(rows.withColumn("category", named), root)


def datasets(rows: DataFrame, tiles: DataFrame, options: Options) -> dict[str, DataFrame]:
    """The datasets by name: three binary ones and two multiclass ones for each policy."""
    own = rows.filter(F.col("chrom").isin(*options.contigs)).persist()
    out: dict[str, DataFrame] = {}
    for policy in options.policies:
        name = {"symmetric": "bidi"}.get(policy, policy)
        for control in CONTROLS:
            windows = context_windows(binary_rows(own, control), tiles, policy)
            out[f"functional-{control}-{name}"] = dataset_rows(windows, F.col("label"), F.lit("full"))
        windows = context_windows(multiclass_rows(own), tiles, policy)
        out[f"functional-multiclass-full-{name}"] = dataset_rows(windows, F.col("label"), F.lit("full"))
        span = stable_subspan(F.col("category"), F.col("pair_id"), F.col("roi_start"), F.col("roi_end"), options.seed)
        pooled = dataset_rows(windows, F.col("label"), F.lit("100bp"), span).filter("pool_start is not null")
        out[f"functional-multiclass-100bp-{name}"] = pooled
    return out


def run(
    spark: SparkSession, data_root: str, regions_dir: str, output_dir: str, options: Options | None = None, track: DataFrame | None = None
) -> dict[str, int]:
    """Write the region tree and all datasets below ``output_dir``; the number of rows of each."""
    options = options or Options()
    if not options.skip_scores and track is None:
        raise FileNotFoundError("a score track is needed unless scores are skipped")
    tiles = stored(scan_fasta(spark, f"{data_root}/genome.fa"), "tiles")
    lengths = stored(contig_lengths(tiles), "lengths")
    if not options.skip_regions:
        write_regions(build_regions(spark, data_root, lengths, options), regions_dir)
    if options.skip_datasets:
        return {}
    from ..sources.writers import read_bed_partitions

    categories = [*CATEGORIES, *([NONCODING] if options.include_noncoding else [])]
    tree = read_bed_partitions(spark, regions_dir)
    roles = F.array(*(F.struct(F.lit(c if r == "feature" else f"{c}_{r}").alias("f"), F.lit(c).alias("c"), F.lit(r).alias("r")) for c in categories for r in ("feature", *CONTROLS)))
    hit = F.get(F.filter(roles, lambda p: p["f"] == F.col("category")), F.lit(0))
    rows = tree.withColumn("_hit", hit).filter("_hit is not null").withColumns({"category": F.col("_hit.c"), "role": F.col("_hit.r")}).drop("_hit")
    counts = {}
    for name, df in datasets(rows, tiles, options).items():
        schema = DATASET if options.skip_scores else with_scores(DATASET)
        whole = df if options.skip_scores else annotate(df, track, lengths)
        counts[name] = write_dataset(whole, f"{output_dir}/{name}.parquet", schema)
    return counts

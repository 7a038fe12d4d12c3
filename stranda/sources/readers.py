"""Readers. Ragged and quoted formats are read as text lines; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import normalize_contig
from ..operators.ids import dense_pair_id
from ..schemas import BED7, ROLES
from .bigwig import scan_bigwig

#: Names under which coordinate tables have their coordinates and ids. Fixed values.
COORDINATE_COLUMNS = ("coordinate_hg38", "coord", "Element Coordinates")
ID_COLUMNS = ("vista_id", "Element ID")


def _fields(line: Column) -> Column:
    return F.split(F.regexp_replace(line, "\r$", ""), "\t", -1)


def _unquoted(field: Column) -> Column:
    return F.when(field.rlike('^".*"$'), F.replace(F.substr(field, F.lit(2), F.char_length(field) - 2), F.lit('""'), F.lit('"'))).otherwise(field)


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source, line_no, line): lines with an order-preserving number within the read."""
    lines = spark.read.text(path)
    return lines.select(F.col("_metadata.file_name").alias("source"), F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))


def in_file_order(rows: DataFrame, name: str = "place") -> DataFrame:
    """Rows just read from files, with their place from 0 over all files: by path, then by place in the file."""
    where = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return dense_pair_id(rows.select("*", where.alias("_where")), "_where", name=name).drop("_where")


def concat_files(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """The rows of tab-separated files with a header each, with ``place``: one file after the other in the order of their paths."""
    return in_file_order(spark.read.csv(path, header=True, sep="\t", quote='"', escape='"', schema=schema))


def scan_bed(
    spark: SparkSession, path: str, category: str, known: list[str], contigs: list[str] | None = None, blocked: DataFrame | None = None
) -> DataFrame:
    """Regions of a BED file of 3 to 6 columns: names default to the category, scores to 0, strands to ``.``.

    Comments, short lines, empty intervals and unknown contigs go; reversed bounds are turned; ``blocked`` (name)
    is anti-joined.
    """
    rows = numbered_lines(spark, path).withColumn("f", F.transform(_fields(F.col("line")), _unquoted))
    rows = rows.filter((F.size("f") >= 3) & ~F.col("line").startswith("#"))
    field = lambda k, default: F.coalesce(F.get("f", F.lit(k)), default)
    a, b = (F.when(F.size("f") >= 3, F.get("f", F.lit(k)).cast("long")) for k in (1, 2))
    out = rows.select(
        normalize_contig(F.get("f", F.lit(0)), known).alias("chrom"), F.least(a, b).alias("start"), F.greatest(a, b).alias("end"),
        field(3, F.lit(category)).alias("name"), field(4, F.lit("0")).cast("double").alias("score"), field(5, F.lit(".")).alias("strand"),
        F.lit(category).alias("category"), F.col("line_no").alias("ord"),
    )
    out = out.filter(F.col("chrom").isin(*(contigs if contigs is not None else known)) & (F.col("end") > F.col("start")))
    return out if blocked is None else out.join(blocked.select("name"), "name", "left_anti").select(*out.columns)


def scan_exclusion_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct names of all but the first of each line's group; commas and white space separate."""
    return exclusion_names(spark.read.text(path).select(F.col("value").alias("line")))


def exclusion_names(lines: DataFrame) -> DataFrame:
    kept = lines.filter(~F.trim("line").startswith("#"))
    words = F.filter(F.split(F.translate("line", ",", " "), r"\s+"), lambda w: w != "")
    return kept.select(F.explode(F.slice(words, 2, 1 << 30)).alias("name")).distinct()


def scan_coord_table(spark: SparkSession, path: str, known: list[str], contigs: list[str] | None = None) -> DataFrame:
    """Regions of a table with a header and ``contig:start-end`` coordinates (1-based starts)."""
    table = spark.read.csv(path, header=True, sep="\t", quote='"', escape='"')
    coordinate = next((c for c in COORDINATE_COLUMNS if c in table.columns), None)
    if coordinate is None:
        raise ValueError(f"{path}: none of the columns {', '.join(COORDINATE_COLUMNS)}")
    name = next((c for c in ID_COLUMNS if c in table.columns), ID_COLUMNS[-1])
    place = F.trim(F.col(f"`{coordinate}`"))
    number = lambda k: F.regexp_extract(place, r"^([^:]+):(\d+)-(\d+)$", k)
    strand = F.when(F.col("strand") != "", F.col("strand")) if "strand" in table.columns else F.lit(None)
    rows = table.withColumn("_ord", F.monotonically_increasing_id()).filter(place != "").select(
        normalize_contig(number(1), known).alias("chrom"), (number(2).cast("long") - 1).alias("start"), number(3).cast("long").alias("end"),
        F.col(f"`{name}`").alias("name"), F.lit(0.0).alias("score"), F.coalesce(strand, F.lit(".")).alias("strand"),
        F.lit("vista_enhancer").alias("category"), F.col("_ord").alias("ord"),
    )
    return rows.filter(F.col("chrom").isin(*(contigs if contigs is not None else known)))


def scan_gtf(spark: SparkSession, path: str | list[str], contigs: list[str] | None = None) -> DataFrame:
    """Annotation lines (plain or gzip) with 0-based starts; files of other contigs, by their name's first part, are left out."""
    lines = numbered_lines(spark, path).filter(~F.col("line").startswith("#"))
    if contigs is not None:
        lines = lines.filter(F.substring_index("source", ".", 1).isin(*contigs))
    f = F.split("line", "\t", -1)
    rows = lines.withColumn("f", f).filter(F.size("f") >= 9)
    at = lambda k: F.get("f", F.lit(k))
    return rows.select(
        "source", "line_no", at(0).alias("chrom"), at(2).alias("kind"), (at(3).cast("long") - 1).alias("start"), at(4).cast("long").alias("end"),
        at(6).alias("strand"), at(7).alias("phase"), at(8).alias("attrs"),
    )


def scan_signal(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start, end, value) of a track: Parquet with these columns, a bigWig file by its name, or else bedGraph text."""
    if path.lower().endswith((".bw", ".bigwig")):
        return scan_bigwig(spark, path)
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path).select("chrom", F.col("start").cast("long"), F.col("end").cast("long"), F.col("value").cast("double"))
    lines = spark.read.text(path).filter(~F.col("value").rlike(r"^(#|track|browser)") & (F.trim("value") != ""))
    f = F.split("value", r"\s+")
    return lines.select(f[0].alias("chrom"), f[1].cast("long").alias("start"), f[2].cast("long").alias("end"), f[3].cast("double").alias("value"))


def scan_bed_tree(spark: SparkSession, root: str, categories: list[str], contigs: list[str]) -> DataFrame:
    """(category, role, chrom, ...) of a tree ``category[_role]/contig.bed`` of seven columns."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.bed").csv(root, schema=BED7, sep="\t", quote='"', escape='"')
    rows = rows.select("*", F.col("_metadata.file_path").alias("_path"), F.monotonically_increasing_id().alias("ord"))
    folder = F.url_decode(F.element_at(F.split("_path", "/"), -2))
    stem = F.regexp_extract("_path", r"([^/]+)\.bed$", 1)
    parts = F.array(*(F.struct(F.lit(c if r == "feature" else f"{c}_{r}").alias("f"), F.lit(c).alias("category"), F.lit(r).alias("role")) for c in categories for r in ROLES))
    hit = F.get(F.filter(parts, lambda p: p["f"] == folder), F.lit(0))
    return rows.filter(stem.isin(*contigs)).withColumn("_hit", hit).filter("_hit is not null").select(
        "_hit.category", "_hit.role", "chrom", "start", "end", "name", "score", "strand", "pair_id", "ord"
    )


def scan_codon_table(spark: SparkSession, path: str | list[str], ordered: bool = False) -> DataFrame:
    """Wide rows of label positions; ``.`` is null but for strands, where it is a value. ``ordered`` adds their place in the files."""
    kinds = ["string"] * 4 + ["long"] * 9
    names = (
        "chrom transcript_id gene_id strand label1_start_pos label2_noncoding_near_pos label2_delta_bp label3_noncoding_far_pos "
        "label3_delta_bp label4_same_inframe_met_pos label4_delta_bp label5_same_outframe_atg_pos label5_delta_bp"
    ).split()
    rows = spark.read.csv(path, header=True, sep="\t", nullValue=".", schema=", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))
    rows = in_file_order(rows) if ordered else rows
    return rows.withColumn("strand", F.coalesce("strand", F.lit(".")))


def scan_repeat_table(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start, end, name, score, strand) of a repeat table, columns 5, 6, 7, 10, 1 and 11 from 0."""
    return repeat_rows(spark.read.text(path).select(_fields(F.col("value")).alias("f")).filter(F.size("f") >= 12))


def repeat_rows(fields: DataFrame) -> DataFrame:
    at = lambda k: F.get("f", F.lit(k))
    return fields.select(
        at(5).alias("chrom"), at(6).cast("long").alias("start"), at(7).cast("long").alias("end"), at(10).alias("name"),
        at(1).cast("double").alias("score"), at(11).alias("strand"),
    )


def scan_gene_table(spark: SparkSession, path: str) -> DataFrame:
    """(name, chrom, strand, tx_start, tx_end, cds_start, cds_end, exon_starts, exon_ends) of a gene table."""
    f = lambda k: F.get("f", F.lit(k))
    many = lambda k: F.transform(F.filter(F.split(f(k), ","), lambda x: x != ""), lambda x: x.cast("long"))
    return spark.read.text(path).select(_fields(F.col("value")).alias("f")).filter(F.size("f") >= 11).select(
        f(1).alias("name"), f(2).alias("chrom"), f(3).alias("strand"), *(f(k).cast("long").alias(n) for k, n in ((4, "tx_start"), (5, "tx_end"), (6, "cds_start"), (7, "cds_end"))),
        many(9).alias("exon_starts"), many(10).alias("exon_ends"),
    )


def derive_utr(genes: DataFrame) -> DataFrame:
    """(chrom, start, end, name, score, strand, utr): what exons have before and after the coding range, by strand."""
    left = F.struct(F.col("tx_start").alias("lo"), F.col("cds_start").alias("hi"))
    right = F.struct(F.col("cds_end").alias("lo"), F.col("tx_end").alias("hi"))
    plus = F.col("strand") == "+"
    bounds = F.array(
        F.struct(F.lit("utr5").alias("utr"), F.when(plus, left).otherwise(right).alias("b")),
        F.struct(F.lit("utr3").alias("utr"), F.when(plus, right).otherwise(left).alias("b")),
    )
    exons = genes.select("*", F.posexplode(F.arrays_zip("exon_starts", "exon_ends")).alias("index", "exon")).withColumn("x", F.explode(bounds))
    cut = exons.select(
        "chrom", F.greatest("exon.exon_starts", "x.b.lo").alias("start"), F.least("exon.exon_ends", "x.b.hi").alias("end"),
        F.concat_ws("_", "name", "x.utr", F.col("index").cast("string")).alias("name"), F.lit(0.0).alias("score"), "strand", F.col("x.utr").alias("utr"),
    )
    return cut.filter("start < end")


def verify_digest(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))

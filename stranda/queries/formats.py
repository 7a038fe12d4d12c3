"""Queries that write a format and read it back, and the smaller operators on their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import sequence as q
from ..functions.attributes import has_tag
from ..functions.hashing import stable_subspan as subspan
from ..operators import checks, intervals, selection, transcripts, windows
from ..schemas import AUTOSOMES, DATASET
from ..sources import readers, writers
from ..sources import fasta as fasta_files
from ..sources.scratch import scratch_path
from . import core
from . import surrogates as s
from .core import query

col, lit = F.col, F.lit
KNOWN = [*AUTOSOMES, "chrX"]


def _text(spark: SparkSession, lines: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    lines.select("value").write.text(path)
    return path


@query(f"""with {s.GENOME}, sized as (select *, length(seq) as n from genome)
 select chrom, tile, tile * 1000 as tile_start, n as length, substring(seq, tile * 1000 + 1, 1050) as seq from (select *, unnest(range(greatest(1, (n + 999) // 1000))) as tile from sized)""")
def scan_fasta(spark: SparkSession, sf: str) -> DataFrame:
    record = F.concat(lit(">"), col("chrom"), lit(" a > header\n"), F.regexp_replace("seq", "(.{60})", "$1\n"))
    return fasta_files.scan_fasta(spark, _text(spark, s.genome(spark, sf).select(record.alias("value")), "fasta"), 1000, 50)


@query(f"""with {s.REGIONS} select chrom, s as "start", e as "end", case when ord % 3 = 0 then 'x' else name end as name, case when ord % 3 < 2 then 0.0::double else ord / 2.0::double end as score,
 case when ord % 3 = 2 then strand else '.' end as strand, 'x' as category from regions where ord % 3 = 0 or name not in ('r1', 'r4', 'r7')""")
def scan_bed(spark: SparkSession, sf: str) -> DataFrame:
    r = s.regions(spark, sf)
    fields = [col("chrom"), col("end").cast("string"), col("start").cast("string")]
    more = [col("name"), (col("ord") / 2).cast("string"), col("strand")]
    line = F.when(col("ord") % 3 == 0, F.concat_ws("\t", *fields)).when(col("ord") % 3 == 1, F.concat_ws("\t", *fields, more[0])).otherwise(F.concat_ws("\t", *fields, *more))
    lines = r.select(line.alias("value")).union(spark.createDataFrame([("# comment",), ("chr1\t5",), ("chr1\t5\t5\tempty",), ("chrUn\t1\t2",), ("",)], "value string"))
    blocked = spark.createDataFrame([("r1",), ("r4",), ("r7",)], "name string")
    return readers.scan_bed(spark, _text(spark, lines, "bed"), "x", KNOWN, blocked=blocked).drop("ord")


_GTF = f"""{s.REGIONS}, lines as (
  select *, case ord % 4 when 0 then 'transcript' when 3 then 'CDS' else 'exon' end as kind, 't' || cast(ord // 4 as varchar) as t, (ord // 4) % 3 <> 0 as canonical from regions)"""


def _scanned(spark: SparkSession, rows: DataFrame, transcript: Column, place: Column, line: Column) -> DataFrame:
    """The annotation with a line for each row, written and read: lines of a transcript are in one file, by place."""
    path = scratch_path(spark, "gtf")
    rows.repartition(transcript).sortWithinPartitions(place).select(line.alias("value")).write.text(path)
    return readers.scan_gtf(spark, path)


def _gtf(spark: SparkSession, sf: str) -> DataFrame:
    k, t = col("ord") % 4, F.floor(col("ord") / 4)
    kind = F.when(k == 0, "transcript").when(k == 3, "CDS").otherwise("exon")
    attrs = F.concat(
        lit('gene_id "g'), (t % 97).cast("string"), lit('"; transcript_id "t'), t.cast("string"), lit('"; transcript_type "protein_coding";'),
        F.when(t % 3 != 0, ' tag "CCDS";').otherwise(""), lit(' tag "basic"'),
    )
    line = F.concat_ws("\t", "chrom", lit("src"), kind, (col("start") + 1).cast("string"), col("end").cast("string"), lit("."), "strand", lit("0"), attrs)
    return _scanned(spark, s.regions(spark, sf), t, col("ord"), line)


@query(f"""with {_GTF} select chrom, kind, s as "start", e as "end", strand, '0' as phase from lines""")
def scan_gtf(spark: SparkSession, sf: str) -> DataFrame:
    return _gtf(spark, sf).select("chrom", "kind", "start", "end", "strand", "phase")


@query(f"""with {_GTF}, heads as (select t, chrom, strand from lines where kind = 'transcript' and canonical)
 select h.t as transcript_id, h.chrom, h.strand, l.kind, l.s as "start", l.e as "end" from heads h join lines l using (t) where l.kind <> 'transcript'""")
def parent_child(spark: SparkSession, sf: str) -> DataFrame:
    return transcripts.canonical_parts(_gtf(spark, sf)).select("transcript_id", "chrom", "strand", "kind", "start", "end")


@query(f"""with {_GTF}, heads as (select t, chrom, strand, s, e from lines where kind = 'transcript' and canonical),
 exons as (select h.t, h.chrom, h.strand, l.s, l.e, lead(l.s) over (partition by h.t order by l.s, l.e) as nxt from heads h join lines l using (t) where l.kind = 'exon')
 select chrom, l.s as "start", l.e as "end", h.t as name, h.strand, 'coding_regions' as category from (select t, chrom, strand from heads) h join (select t, s, e from lines where kind = 'CDS') l using (t)
 union all select chrom, s, e, t, strand, 'exons' from exons union all select chrom, e, nxt, t, strand, 'introns' from exons where nxt > e
 union all select chrom, case when strand = '+' then s - 2000 else e end, case when strand = '+' then s else e + 2000 end, t, strand, 'upstream_TSS' from heads""")
def gene_features(spark: SparkSession, sf: str) -> DataFrame:
    return transcripts.gene_features(_gtf(spark, sf)).select("chrom", "start", "end", "name", "strand", "category")


_MIXED_GTF = f"""{s.REGIONS}, mixed as (
  select t, case when t % 13 = 4 then -ord else ord end as place, (t + k) % 3 <> 0 as protein_coding,
   case when k = 0 or k = 2 and (t % 17 = 5 or t % 19 = 6) then 'transcript' when k = 3 then 'CDS' when k = 1 and t % 29 = 9 then 'start_codon' else 'exon' end as kind,
   not (k = 0 and t % 11 = 3 or k = 3 and t % 23 = 8) as has_id,
   not (k = 0 and t % 5 = 1 or k = 2 and t % 19 = 6 or k in (1, 3) and t % 4 = 2) as has_gene, not (k = 0 and t % 7 = 2) as has_type
  from (select ord, ord // 4 as t, ord % 4 as k from regions))"""


def _mixed_gtf(spark: SparkSession, sf: str) -> DataFrame:
    """An annotation with lines that do not count: transcripts without id, gene or type, parts of such, parts before their transcript or its last line, and other kinds."""
    k, t = col("ord") % 4, F.floor(col("ord") / 4)
    again = (t % 17 == 5) | (t % 19 == 6)
    kind = F.when((k == 0) | (k == 2) & again, "transcript").when(k == 3, "CDS").when((k == 1) & (t % 29 == 9), "start_codon").otherwise("exon")
    item = lambda key, value: F.concat(lit(f'{key} "'), value, lit('"; '))
    attrs = F.concat(
        F.when((k == 0) & (t % 5 == 1) | (k == 2) & (t % 19 == 6) | k.isin(1, 3) & (t % 4 == 2), "").otherwise(item("gene_id", (t % 97).cast("string"))),
        F.when((k == 0) & (t % 11 == 3), "").otherwise(item("transcript_id", F.when((k == 3) & (t % 23 == 8), "").otherwise(t.cast("string")))),
        item("transcript_type", F.when((k == 0) & (t % 7 == 2), "").when((t + k) % 3 == 0, "lncRNA").otherwise("protein_coding")),
    )
    place = F.when(t % 13 == 4, -col("ord")).otherwise(col("ord"))
    line = F.concat_ws("\t", "chrom", lit("src"), kind, (col("start") + 1).cast("string"), col("end").cast("string"), lit("."), "strand", lit("0"), attrs)
    return _scanned(spark, s.regions(spark, sf), t, place, line)


@query(f"""with {_MIXED_GTF},
 heads as (select t, max(place) as place, arg_max(protein_coding, place) as protein_coding from mixed where kind = 'transcript' and has_id and has_gene and has_type group by t),
 parts as (select m.kind, h.protein_coding from heads h join mixed m using (t) where m.has_id and m.place > h.place)
 select (select count(*) from heads) as n_transcripts, count(*) filter (kind = 'exon') as n_exons, count(*) filter (kind = 'CDS') as n_cds,
  count(*) filter (kind = 'CDS' and protein_coding) as n_coding_regions from parts""")
def feature_kind(spark: SparkSession, sf: str) -> DataFrame:
    """How many lines of an annotation count as transcripts, exons and CDS of a known transcript, and coding regions of protein-coding ones."""
    counts = {"n_transcripts": col("kind") == "transcript", "n_exons": col("kind") == "exon", "n_cds": col("kind") == "CDS", "n_coding_regions": col("coding")}
    return transcripts.feature_lines(_mixed_gtf(spark, sf)).agg(*(F.count_if(c).alias(n) for n, c in counts.items()))


@query(f"""with {s.REGIONS} select chrom, s as "start", e as "end", name, cast(ord % 1000 as double) as score, strand from regions""")
def scan_repeat_table(spark: SparkSession, sf: str) -> DataFrame:
    x = lit("x")
    fields = [x, (col("ord") % 1000).cast("string"), x, x, x, col("chrom"), col("start").cast("string"), col("end").cast("string"), x, x, col("name"), col("strand"), x]
    return readers.scan_repeat_table(spark, _text(spark, s.regions(spark, sf).select(F.concat_ws("\t", *fields).alias("value")), "repeats"))


@query(f"""with {s.REGIONS} select chrom, s as "start", e as "end", name, case when strand = '+' then '.' else strand end as strand from regions""")
def scan_coord_table(spark: SparkSession, sf: str) -> DataFrame:
    place = F.concat(col("chrom"), lit(":"), (col("start") + 1).cast("string"), lit("-"), col("end").cast("string"))
    path = scratch_path(spark, "coords")
    table = s.regions(spark, sf).select(col("name").alias("vista_id"), place.alias("coord"), F.when(col("strand") != "+", col("strand")).alias("strand"))
    table.write.option("header", "true").option("sep", "\t").csv(path)
    return readers.scan_coord_table(spark, path, KNOWN).select("chrom", "start", "end", "name", "strand")


@query("select 'u' || cast(user_id as varchar) as chrom, event_id as \"start\", event_id + 1 as \"end\", round_even(value * 100, 0) / 100 as value from events")
def scan_signal(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.signal import round_score

    line = F.concat_ws(" ", F.concat(lit("u"), col("user_id").cast("string")), col("event_id").cast("string"), (col("event_id") + 1).cast("string"), col("value").cast("string"))
    track = readers.scan_signal(spark, _text(spark, s.table(spark, sf, "events").select(line.alias("value")), "track"))
    return track.withColumn("value", round_score(col("value")))


@query(f"""with {s.LABEL_TABLE} select chrom, transcript_id, gene_id, strand, p1 as label1_start_pos, p2 as label2_noncoding_near_pos, cast(d2 as bigint) as label2_delta_bp, p3 as label3_noncoding_far_pos,
 cast(d3 as bigint) as label3_delta_bp, p4 as label4_same_inframe_met_pos, cast(d4 as bigint) as label4_delta_bp, p5 as label5_same_outframe_atg_pos, cast(d5 as bigint) as label5_delta_bp from wide""")
def write_tsv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "labels")
    writers.write_tsv(s.label_table(spark, sf), path)
    return readers.scan_codon_table(spark, path)


@query(f"""with {s.ROLE_ROWS} select category || case when role = 'feature' then '' else '_' || role end as category, chrom, s as "start", e as "end", name, strand, pair_id from role_rows""")
def write_bed_tree(spark: SparkSession, sf: str) -> DataFrame:
    named = F.when(col("role") == "feature", col("category")).otherwise(F.concat_ws("_", "category", "role"))
    path = scratch_path(spark, "beds")
    writers.write_bed_tree(s.role_rows(spark, sf).withColumns({"category": named, "score": lit(0.0)}), path)
    return writers.read_bed_partitions(spark, path).select("category", "chrom", "start", "end", "name", "strand", "pair_id")


@query(core.ORACLES["context_window_causal"])
def write_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The dataset as read back, after it has replaced an older one."""
    path = scratch_path(spark, "dataset")
    rows = core.context_window_causal(spark, sf)
    writers.write_dataset(rows.filter("strand = '-'"), path, DATASET)
    if writers.write_dataset(rows, path, DATASET) != spark.read.parquet(path).count():
        raise AssertionError("the dataset has another number of rows than were counted")
    return spark.read.parquet(path)


@query(f"""with {s.REGIONS} select chrom, ord, s as "start", row_number() over (order by chrom, ord) - 1 as place from regions""")
def concat_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "files")
    rows = s.regions(spark, sf).select("chrom", "ord", "start", col("chrom").alias("contig"))
    sorted_files = rows.repartition("contig").sortWithinPartitions("contig", "ord")
    sorted_files.write.partitionBy("contig").option("header", "true").option("sep", "\t").csv(path)
    return readers.concat_files(spark, f"{path}/contig=*", "chrom string, ord long, start long")


_PLANTED = f"""{core.ORACLES["context_window_causal"].replace("select 'train' as split", ", good as (select 'train' as split", 1)}),
 numbered as (select *, cast(pair_id as bigint) as k from good),
 planted as (select case when k % 101 = 1 then 'dev' else split end as split, case when k % 67 = 2 then '' else sequence end as sequence, 'feature' as label, pair_id, category, scope,
   case when k % 83 = 3 then 'symmetric' else context_policy end as context_policy, chrom, case when k % 59 = 4 then roi_end else roi_start end as roi_start, roi_end, pool_start,
   case when k % 71 = 5 then 4000 else pool_end end as pool_end from numbered union all
  select split, sequence, case when k % 53 = 6 then 'feature' else 'upstream' end, pair_id, category, scope, context_policy, chrom, roi_start, roi_end, pool_start, pool_end from numbered where k % 7 <> 0),
 pairs as (select category, pair_id, count(*) as n, count(*) - count(distinct label) as again, string_agg(label, ',' order by label) as labels from planted group by 1, 2)"""

_ASSERTED = {
    "n_rows": "count(*)", "bad_length": "count(*) filter (length(sequence) not between 1 and 2048)", "bad_roi": "count(*) filter (roi_start < 0 or roi_start >= roi_end)",
    "bad_pool": "count(*) filter (pool_start < 0 or pool_start >= pool_end or pool_end > length(sequence))", "pool_outside_roi": "count(*) filter (pool_start < roi_start or pool_end > roi_end)",
    "bad_policy": "count(*) filter (context_policy <> 'causal')", "unknown_split": "count(*) filter (split not in ('train', 'test'))", "contig_in_wrong_split": "0",
    "split_missing": "1", "held_out_contig_missing": "4", "noncoding_missing": "1",
    "repeated_keys": "(select sum(again) from pairs)", "pair_without_its_labels": "(select count(*) filter (labels <> 'feature,upstream') from pairs)",
}


@query(f"with {_PLANTED.removeprefix('with ')} " + " union all ".join(f"select '{k}' as assertion, cast({v} as bigint) as violations{' from planted' if v.startswith('count') else ''}" for k, v in _ASSERTED.items()))
def validate_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Every assertion on a dataset of pairs with planted violations, in one pass."""
    good = core.context_window_causal(spark, sf).withColumn("k", col("pair_id").cast("long"))
    put = lambda c, n, k, v: F.when(col("k") % n == k, v).otherwise(col(c))
    feature = good.withColumns(
        {
            "label": lit("feature"), "split": put("split", 101, 1, lit("dev")), "sequence": put("sequence", 67, 2, lit("")), "context_policy": put("context_policy", 83, 3, lit("symmetric")),
            "roi_start": put("roi_start", 59, 4, col("roi_end")), "pool_end": put("pool_end", 71, 5, lit(4000)),
        }
    )
    control = good.filter("k % 7 <> 0").withColumn("label", F.when(col("k") % 53 == 6, "feature").otherwise("upstream"))
    return checks.assertions(feature.unionByName(control).drop("k"), "binary", "causal", "upstream")


# ---- smaller operators on their own ----


@query(f"with {s.REGIONS} select ord, 2048 - (s % 1000 + 50) as roi_start, 2048 - s % 1000 as roi_end from regions")
def mirror_offsets(spark: SparkSession, sf: str) -> DataFrame:
    low, high = g.mirrored(col("start") % 1000, col("start") % 1000 + 50, lit(2048))
    return s.regions(spark, sf).select("ord", low.alias("roi_start"), high.alias("roi_end"))


@query()
def stable_subspan(spark: SparkSession, sf: str) -> DataFrame:
    first, last = subspan(col("category"), col("ord"), lit(0), (col("end") - col("start")).cast("int"))
    return s.regions(spark, sf).select("ord", first.alias("pool_start"), last.alias("pool_end"))


@query(f"with {s.REGIONS} select ord, chrom from regions where chrom in ('chr1', 'chr2', 'chrX')")
def contig_filter(spark: SparkSession, sf: str) -> DataFrame:
    return s.regions(spark, sf).filter(col("chrom").isin("chr1", "chr2", "chrX")).select("ord", "chrom")


@query(f"with {s.REGIONS} select ord, category from regions where category <> '5-LOW'")
def exclude_category(spark: SparkSession, sf: str) -> DataFrame:
    return s.regions(spark, sf).filter(col("category") != "5-LOW").select("ord", "category")


@query(f"with {s.ANNOTATION} select event_id, contains(attrs, 'tag \"click\"') as canonical from annotation")
def canonical_tag(spark: SparkSession, sf: str) -> DataFrame:
    return s.annotation(spark, sf).select("event_id", has_tag(col("attrs"), "click").alias("canonical"))


@query(f"with {s.GENOME} select chrom, starts_with(substring(seq, doc_id % 50 + 1), 'ATG') as starts from genome")
def starts_with_codon(spark: SparkSession, sf: str) -> DataFrame:
    cut = q.slice_of(col("seq"), col("doc_id") % 50, F.char_length("seq"))
    return s.genome(spark, sf).select("chrom", cut.startswith("ATG").alias("starts"))


@query(f"with {s.REGIONS} select ord from regions where s - 500 >= 0 and e + 500 <= 40200")
def bounds_check(spark: SparkSession, sf: str) -> DataFrame:
    return s.regions(spark, sf).filter(g.within_contig(col("start") - 500, col("end") + 500, lit(s.CONTIG_LENGTH))).select("ord")


@query(f"with {s.REGIONS} select ord, 40200 - e as rest from regions")
def contig_length_join(spark: SparkSession, sf: str) -> DataFrame:
    lengths = F.broadcast(s.lengths(spark, sf))  # a row for each contig
    return s.regions(spark, sf).join(lengths, "chrom").select("ord", (col("length") - col("end")).alias("rest"))


@query(f"with {s.ROLE_ROWS} select category, pair_id, count(*) as n_rows from role_rows group by 1, 2 having count(*) <> 4")
def group_size(spark: SparkSession, sf: str) -> DataFrame:
    return checks.row_counts(s.role_rows(spark, sf), "category", "pair_id").filter("n_rows <> 4")


@query(f"with {s.ROLE_ROWS} select distinct role from role_rows")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([(v,) for v in checks.distinct_values(s.role_rows(spark, sf), "role")], "role string")


@query(f"""with {s.REGIONS} select category, ord, row_number() over (partition by category order by md5('42|' || cast(ord as varchar)), ord) - 1 as rank from regions""")
def seeded_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    return selection.seeded_shuffle(s.regions(spark, sf), 42, "ord").select("category", "ord", "rank")


@query(f"with {s.BLOCKS} select ord, string_agg(cast(s as varchar), ',' order by case when strand = '-' then -s else s end) as starts from segments group by ord")
def sort_intervals(spark: SparkSession, sf: str) -> DataFrame:
    ordered = intervals.sorted_intervals(col("segments"), col("strand") == "-")
    return s.segments(spark, sf).select("ord", F.array_join(F.transform(ordered, lambda x: x["start"].cast("string")), ",").alias("starts"))


@query(f"with {s.REGIONS} select category, ord from regions where category = '1-URGENT' union all select category || '_up', ord from regions where category = '5-LOW'")
def union_categories(spark: SparkSession, sf: str) -> DataFrame:
    r = s.regions(spark, sf).select("category", "ord")
    return r.filter("category = '1-URGENT'").unionByName(r.filter("category = '5-LOW'").withColumn("category", F.concat("category", lit("_up"))))


@query(f"with {s.DOC_REGIONS} select pair_id, 'train' as split, cast(pair_id as varchar) || '-full' as name from doc_regions where e > s")
def project_row(spark: SparkSession, sf: str) -> DataFrame:
    tiles = windows.tile_genome(s.genome(spark, sf))
    rows = windows.dataset_rows(windows.context_windows(s.doc_regions(spark, sf), tiles), col("category"), lit("full"))
    return rows.select(col("pair_id").cast("long").alias("pair_id"), "split", F.concat_ws("-", "pair_id", "scope").alias("name"))

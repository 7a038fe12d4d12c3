"""Queries by name, each beside its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import sequence as q
from ..functions.attributes import has_tag, parse_attributes
from ..functions.hashing import stable_subspan
from ..operators import checks, controls, intervals, nearest, pairs, selection, signal, transcripts, windows
from ..schemas import AUTOSOMES
from ..sources import readers
from ..sources.scratch import stored
from . import surrogates as s

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return register


col, lit = F.col, F.lit
SPAN = '"start", "end"'

# ---- sequence and geometry ----


@query(f"with {s.GENOME} select chrom, reverse(translate(seq, 'ACGTNacgtn', 'TGCANtgcan')) as revcomp from genome")
def revcomp_genome(spark: SparkSession, sf: str) -> DataFrame:
    return s.genome(spark, sf).select("chrom", q.reverse_complement(col("seq")).alias("revcomp"))


_LONG = f"{s.REGIONS}, long as (select ord, strand, s, least(40200, s + (e - s) * case when ord % 10 = 0 then 40 else 1 end) as e from regions)"
_CAUSAL = """case when strand = '+' then greatest(0, e - w) else s end as context_start,
 case when strand = '+' then e else least({n}, s + w) end as context_end"""
_SYMMETRIC = """greatest(0, least({n}, greatest(0, (s + e) // 2 - 1024) + 2048) - 2048) as context_start,
 least({n}, greatest(0, (s + e) // 2 - 1024) + 2048) as context_end"""
_WIDTH = "case when e - s > 2048 then 1000 else 2048 end as w"


def _bounds(spark: SparkSession, sf: str, policy: str) -> DataFrame:
    stretched = (col("end") - col("start")) * F.when(col("ord") % 10 == 0, 40).otherwise(1)
    rows = s.regions(spark, sf).withColumn("end", F.least(lit(s.CONTIG_LENGTH), col("start") + stretched))
    first, last = g.context_bounds(lit(s.CONTIG_LENGTH), col("start"), col("end"), col("strand"), policy=policy)
    return rows.select("ord", first.alias("context_start"), last.alias("context_end"))


@query(f"with {_LONG} select ord, {_CAUSAL.format(n=40200)} from (select *, {_WIDTH} from long)")
def context_bounds_causal(spark: SparkSession, sf: str) -> DataFrame:
    return _bounds(spark, sf, "causal")


@query(f"with {_LONG} select ord, {_SYMMETRIC.format(n=40200)} from long")
def context_bounds_symmetric(spark: SparkSession, sf: str) -> DataFrame:
    return _bounds(spark, sf, "symmetric")


def _window_sql(bounds: str, policy: str) -> str:
    return f"""with {s.DOC_REGIONS},
 framed as (select *, {bounds} from (select *, {_WIDTH} from doc_regions)),
 cut as (select *, substring(seq, context_start + 1, context_end - context_start) as piece, greatest(0, s - context_start) as a,
                least(context_end - context_start, e - context_start) as b, context_end - context_start as size from framed)
 select 'train' as split, case when strand = '-' then reverse(translate(piece, 'ACGTNacgtn', 'TGCANtgcan')) else piece end as sequence,
  'doc' as label, cast(pair_id as varchar) as pair_id, 'doc' as category, 'full' as scope, '{policy}' as context_policy, chrom,
  s as "start", e as "end", strand, context_start, context_end,
  cast(case when strand = '-' then size - b else a end as integer) as roi_start, cast(case when strand = '-' then size - a else b end as integer) as roi_end,
  cast(case when strand = '-' then size - b else a end as integer) as pool_start, cast(case when strand = '-' then size - a else b end as integer) as pool_end,
  'd' || cast(pair_id as varchar) as name
 from cut where b > a"""


def _windows(spark: SparkSession, sf: str, policy: str) -> DataFrame:
    # tiles are read for lengths and for bases
    tiles = stored(windows.tile_genome(s.genome(spark, sf)), "tiles")
    return windows.dataset_rows(windows.context_windows(s.doc_regions(spark, sf), tiles, policy), col("category"), lit("full"))


@query(_window_sql(_CAUSAL.format(n="n"), "causal"))
def context_window_causal(spark: SparkSession, sf: str) -> DataFrame:
    return _windows(spark, sf, "causal")


@query(_window_sql(_SYMMETRIC.format(n="n"), "symmetric"))
def context_window_symmetric(spark: SparkSession, sf: str) -> DataFrame:
    return _windows(spark, sf, "symmetric")


@query(f'with {s.DOC_REGIONS} select pair_id, substring(seq, s + 1, e - s) as sequence from doc_regions')
def genome_lookup(spark: SparkSession, sf: str) -> DataFrame:
    tiles = windows.tile_genome(s.genome(spark, sf), 1024, 511)
    return windows.genome_lookup(s.doc_regions(spark, sf), tiles, "start", "end", 1024).select("pair_id", "sequence")


@query(f"with {s.GENOME} select chrom, cast(length(seq) as bigint) as length from genome")
def contig_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return windows.contig_lengths(windows.tile_genome(s.genome(spark, sf)))


@query(f"""with {s.REGIONS}, raw as (
  select ord, case ord % 4 when 0 then chrom when 1 then substring(chrom, 4) when 2 then 'M' else 'chrUn' || cast(ord % 3 as varchar) end as raw from regions)
 select ord, raw, case when raw = 'M' then 'MT' when regexp_matches(raw, '^([0-9]+|X)$') then 'chr' || raw else raw end as chrom from raw""")
def normalize_contig(spark: SparkSession, sf: str) -> DataFrame:
    k = col("ord") % 4
    raw = F.when(k == 0, col("chrom")).when(k == 1, F.substr("chrom", lit(4))).when(k == 2, "M").otherwise(F.concat(lit("chrUn"), (col("ord") % 3).cast("string")))
    known = [*AUTOSOMES, "chrX", "MT"]
    return s.regions(spark, sf).select("ord", raw.alias("raw")).select("ord", "raw", g.normalize_contig(col("raw"), known).alias("chrom"))


@query(f"""with {s.REGIONS}, raw as (select ord, case when ord % 3 = 0 then e else s end as a, case when ord % 7 = 0 then (case when ord % 3 = 0 then e else s end)
  when ord % 3 = 0 then s else e end as b from regions) select ord, least(a, b) as "start", greatest(a, b) as "end" from raw where a <> b""")
def swap_bounds(spark: SparkSession, sf: str) -> DataFrame:
    a = F.when(col("ord") % 3 == 0, col("end")).otherwise(col("start"))
    b = F.when(col("ord") % 7 == 0, a).when(col("ord") % 3 == 0, col("start")).otherwise(col("end"))
    low, high = g.ordered_bounds(a, b)
    return s.regions(spark, sf).select("ord", low.alias("start"), high.alias("end")).filter("end > start")


@query(f"""with {s.REGIONS} select ord, case when strand = '+' then s - 2000 else e end as "start", case when strand = '+' then s else e + 2000 end as "end" from regions""")
def upstream_tss(spark: SparkSession, sf: str) -> DataFrame:
    low, high = g.upstream_tss(col("start"), col("end"), col("strand"))
    return s.regions(spark, sf).select("ord", low.alias("start"), high.alias("end"))


@query(f"""with {s.REGIONS}, f as (select ord, case when strand = '-' then e + 2000 else s - 2000 - (e - s) end as a, case when strand = '-' then e + 2000 + (e - s) else s - 2000 end as b from regions)
 select ord, a as "start", b as "end", a >= 0 and b <= 40200 as inside from f""")
def shifted_flank(spark: SparkSession, sf: str) -> DataFrame:
    low, high = g.shifted_flank(col("start"), col("end"), col("strand"), 2000)
    return s.regions(spark, sf).select("ord", low.alias("start"), high.alias("end"), g.within_contig(low, high, lit(s.CONTIG_LENGTH)).alias("inside"))


@query(f"""with {s.REGIONS} select ord, case when strand = '-' then s + 2048 - 150 else s + 50 end as "start", case when strand = '-' then s + 2048 - 50 else s + 150 end as "end" from regions""")
def oriented_pool_span(spark: SparkSession, sf: str) -> DataFrame:
    low, high = g.oriented_pool_span(col("strand"), col("start"), col("start") + 2048, lit(50), lit(150))
    return s.regions(spark, sf).select("ord", low.alias("start"), high.alias("end"))


_ROI = """case when scope = '100bp' then (case when strand = '-' then n - (s + 1) else s end) else s end as rs,
 case when scope = '100bp' then (case when strand = '-' then n - s else s + 1 end) else e end as re"""


@query(f"""with {s.REGIONS}, x as (select ord, strand, category, s, least(40200, s + (e - s) * 40) as e, s as cs, s + 2048 as ce from regions),
 y as (select *, {_SYMMETRIC.format(n=40200)} from x)
 select ord, case when ord % 2 = 0 then (case when strand = '-' then ce - 150 else cs + 50 end) else greatest(s, context_start) end as "start",
        case when ord % 2 = 0 then (case when strand = '-' then ce - 50 else cs + 150 end) else least(e, context_end) end as "end" from y""")
def baseline_roi_span(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.regions(spark, sf).withColumn("end", F.least(lit(s.CONTIG_LENGTH), col("start") + (col("end") - col("start")) * 40))
    scope = F.when(col("ord") % 2 == 0, "100bp").otherwise("full")
    low, high = g.baseline_roi_span(scope, lit(s.CONTIG_LENGTH), col("start"), col("end"), col("strand"), col("start"), col("start") + 2048, lit(50), lit(150))
    return rows.select("ord", low.cast("long").alias("start"), high.cast("long").alias("end"))


@query(f"with {s.REGIONS} select ord, chrom || '|' || name || '|' || strand || '|' || cast(s as varchar) as pair_id from regions")
def composite_key(spark: SparkSession, sf: str) -> DataFrame:
    return s.regions(spark, sf).select("ord", g.composite_key(col("chrom"), col("name"), col("strand"), col("start")).alias("pair_id"))


@query(f"with {s.REGIONS} select case when chrom in ('chr2', 'chr3', 'chr16', 'chr22') then 'test' else 'train' end as split, chrom, count(*) as n_rows from regions group by 1, 2")
def assign_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.row_counts(s.regions(spark, sf).withColumn("split", g.assign_split(col("chrom"))), "split", "chrom")


# ---- intervals ----


def _merged_sql(comparison: str, source: str = "regions") -> str:
    return f"""ordered as (select chrom, s, e, max(e) over (partition by chrom order by s, e rows between unbounded preceding and 1 preceding) as reached from {source}),
 numbered as (select *, sum(case when reached is null or s {comparison} reached then 1 else 0 end) over (partition by chrom order by s, e rows unbounded preceding) as island from ordered),
 merged as (select chrom, min(s) as s, max(e) as e from numbered group by chrom, island)"""


@query(f'with {s.REGIONS}, {_merged_sql(">")} select chrom, s as "start", e as "end" from merged')
def merge_touching(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.merge_intervals(s.regions(spark, sf), True)


@query(f'with {s.REGIONS}, {_merged_sql(">=")} select chrom, s as "start", e as "end" from merged')
def merge_strict(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.merge_intervals(s.regions(spark, sf), False)


@query(f"""with {s.REGIONS}, {_merged_sql(">")}, gaps as (
  select chrom, lag(e, 1, 0) over (partition by chrom order by s) as a, s as b from merged union all select chrom, max(e), 40200 from merged group by chrom)
 select chrom, cast(a as bigint) as "start", cast(b as bigint) as "end" from gaps where a < b""")
def complement_regions(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.complement(s.regions(spark, sf), s.lengths(spark, sf))


_EXONS = "exons as (select l_orderkey as t, l_partkey * 10 + l_linenumber * 37 as s, l_partkey * 10 + l_linenumber * 37 + cast(l_quantity as bigint) as e from lineitem)"


def _exons(spark: SparkSession, sf: str) -> DataFrame:
    start = col("l_partkey") * 10 + col("l_linenumber") * 37
    return s.table(spark, sf, "lineitem").select(col("l_orderkey").alias("transcript_id"), start.alias("start"), (start + col("l_quantity").cast("long")).alias("end"))


@query(f"""with {_EXONS}, following as (select t, e, lead(s) over (partition by t order by s, e) as nxt from exons)
 select t as transcript_id, e as "start", nxt as "end" from following where nxt > e""")
def introns_between_exons(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.introns(_exons(spark, sf)).select("transcript_id", "start", "end")


@query(f"with {_EXONS} select t as transcript_id, count(*) as n_exons, min(s) as first, max(e) as last, string_agg(cast(s as varchar) || '-' || cast(e as varchar), ',' order by s, e) as spans from exons group by t")
def transcript_spans(spark: SparkSession, sf: str) -> DataFrame:
    grouped = _exons(spark, sf).groupBy("transcript_id").agg(
        F.count("*").alias("n_exons"), F.min("start").alias("first"), F.max("end").alias("last"), F.collect_list(F.struct("start", "end")).alias("spans")
    )
    text = F.transform(intervals.sorted_intervals(col("spans")), lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string")))
    return grouped.withColumn("spans", F.array_join(text, ","))


_AB = f"{s.REGIONS}, a as (select * from regions where category = '1-URGENT'), b as (select * from regions where category = '5-LOW')"


def _ab(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    r = s.regions(spark, sf)
    return r.filter("category = '1-URGENT'"), r.filter("category = '5-LOW'").select("chrom", "start", "end")


@query(f'with {_AB} select ord, chrom, s as "start", e as "end" from a where exists (select 1 from b where b.chrom = a.chrom and b.s < a.e and a.s < b.e)')
def overlap_semi(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.overlap_semi(*_ab(spark, sf)).select("ord", "chrom", "start", "end")


@query(f'with {_AB} select ord, chrom, s as "start", e as "end" from a where not exists (select 1 from b where b.chrom = a.chrom and b.s < a.e and a.s < b.e)')
def overlap_anti(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.overlap_anti(*_ab(spark, sf)).select("ord", "chrom", "start", "end")


@query(f"with {_AB} select a.ord as a_ord, b.ord as b_ord, least(a.e, b.e) - greatest(a.s, b.s) as shared from a join b on a.chrom = b.chrom and a.s < b.e and b.s < a.e")
def overlap_pairs(spark: SparkSession, sf: str) -> DataFrame:
    r = s.regions(spark, sf).select("chrom", "start", "end", "ord", "category")
    found = intervals.overlap_pairs(r.filter("category = '1-URGENT'"), r.filter("category = '5-LOW'"), 1024)
    return found.select("a_ord", "b_ord", (F.least("a_end", "b_end") - F.greatest("a_start", "b_start")).alias("shared"))


_MOTIF = f"{s.GENOME}, hits as (select chrom, pos from (select chrom, seq, unnest(range(greatest(length(seq) - 2, 0))) as pos from genome) where substring(seq, pos + 1, 3) = 'ATG')"


@query(f"with {_MOTIF} select chrom, pos from hits")
def motif_scan(spark: SparkSession, sf: str) -> DataFrame:
    return windows.motif_scan(windows.tile_genome(s.genome(spark, sf), 4096, 2047), "ATG", 4096)


@query(f"""with {s.DOC_REGIONS}, hits as (select chrom, pos from (select chrom, seq, unnest(range(greatest(length(seq) - 2, 0))) as pos from genome) where substring(seq, pos + 1, 3) = 'ATG'),
 {_merged_sql(">", "doc_regions")}
 select chrom, pos from hits h where not exists (select 1 from merged m where m.chrom = h.chrom and h.pos >= m.s and h.pos + 3 <= m.e)""")
def outside_intervals(spark: SparkSession, sf: str) -> DataFrame:
    hits = windows.motif_scan(windows.tile_genome(s.genome(spark, sf)))
    return intervals.outside_intervals(hits, s.doc_regions(spark, sf).select("chrom", "start", "end"))


# ---- transcripts ----


@query(f'with {s.BLOCKS} select ord, s as "start", e as "end", o as "offset" from blocks')
def trimmed_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return s.segments(spark, sf).select("ord", F.explode(q.trimmed_blocks(col("segments"), col("strand"))).alias("b")).select("ord", "b.*")


@query(f"with {s.BLOCKS} select ord, cast(sum(e - s) as bigint) as bases from blocks group by ord having sum(e - s) >= 3")
def min_cds_length(spark: SparkSession, sf: str) -> DataFrame:
    bases = q.blocks_length(q.trimmed_blocks(col("segments"), col("strand")))
    return s.segments(spark, sf).select("ord", bases.alias("bases")).filter("bases >= 3")


@query(f"""with {s.BLOCKS}, wanted as (select ord, (ord * 17) % 300 as at from regions where strand <> '.')
 select w.ord, w.at, case when b.strand = '+' then b.s + w.at - b.o else b.e - 1 - (w.at - b.o) end as pos
 from wanted w left join blocks b on b.ord = w.ord and b.o <= w.at and w.at < b.o + b.e - b.s""")
def genomic_position(spark: SparkSession, sf: str) -> DataFrame:
    at = (col("ord") * 17) % 300
    blocks = q.trimmed_blocks(col("segments"), col("strand"))
    return s.segments(spark, sf).withColumns({"at": at, "blocks": blocks}).select("ord", "at", q.genomic_position(col("blocks"), col("at"), col("strand")).alias("pos"))


def _two_blocks(spark: SparkSession, sf: str) -> DataFrame:
    n = F.char_length("seq").cast("long")
    cuts = F.array(F.struct((n / 4).cast("long").alias("start"), (n / 3).cast("long").alias("end")), F.struct((n / 2).cast("long").alias("start"), n.alias("end")))
    strand = F.when(col("doc_id") % 2 == 0, "+").otherwise("-")
    return s.genome(spark, sf).select("chrom", "seq", cuts.alias("cuts"), strand.alias("strand")).withColumn("cuts", intervals.sorted_intervals(col("cuts"), col("strand") == "-"))


_PIECES = f"""{s.GENOME}, pieces as (select chrom, case when doc_id % 2 = 0 then '+' else '-' end as strand,
  substring(seq, length(seq) // 4 + 1, length(seq) // 3 - length(seq) // 4) as a, substring(seq, length(seq) // 2 + 1) as b from genome)"""


@query(f"with {_PIECES} select chrom, case when strand = '+' then a || b else reverse(translate(b || a, 'ACGTN', 'TGCAN')) end as spliced from pieces")
def splice_sequence(spark: SparkSession, sf: str) -> DataFrame:
    return _two_blocks(spark, sf).select("chrom", q.spliced_sequence(col("seq"), col("cuts"), col("strand")).alias("spliced"))


@query(f"with {_PIECES} select chrom, case when strand = '+' then a || b else reverse(translate(b, 'ACGTN', 'TGCAN')) || reverse(translate(a, 'ACGTN', 'TGCAN')) end as spliced from pieces")
def splice_sequence_by_exon(spark: SparkSession, sf: str) -> DataFrame:
    return _two_blocks(spark, sf).select("chrom", q.spliced_sequence(col("seq"), col("cuts"), col("strand"), False).alias("spliced"))


@query(f"with {_MOTIF} select chrom, pos, case when pos = 0 then 'start' when pos % 3 = 0 then 'inframe' else 'outframe' end as frame from hits")
def reading_frame(spark: SparkSession, sf: str) -> DataFrame:
    hits = windows.motif_scan(windows.tile_genome(s.genome(spark, sf)))
    return hits.withColumn("frame", q.reading_frame(col("pos")))


_SPLICED = f"""{s.GENOME}, placed as (
  select chrom, seq, length(seq) as n, case when doc_id % 2 = 0 then '+' else '-' end as strand, case when doc_id % 2 = 0 then instr(seq, 'ATG') - 1 else instr(seq, 'CAT') - 1 end as p from genome),
 cut as (select chrom, strand, case when strand = '+' then p else greatest(0, p - 300) end as s1, case when strand = '+' then least(n, p + 300) else p + 3 end as e1,
   case when strand = '+' then p + 400 else p + 100 end as s2, least(n, p + 900) as e2, seq from placed where p >= 0),
 joined as (select chrom, strand, s1, e1, s2, greatest(s2, e2) as e2, substring(seq, s1 + 1, e1 - s1) as a, substring(seq, s2 + 1, greatest(0, e2 - s2)) as b from cut),
 spliced as (select *, case when strand = '+' then a || b else reverse(translate(b || a, 'ACGTN', 'TGCAN')) end as x from joined),
 hits as (select *, unnest(range(greatest(length(x) - 2, 0))) as o from spliced where starts_with(x, 'ATG')),
 found as (select chrom, o, case when strand = '+' then (case when o < e1 - s1 then s1 + o else s2 + o - (e1 - s1) end) else (case when o < e2 - s2 then e2 - 1 - o else e1 - 1 - (o - (e2 - s2)) end) end as pos
  from hits where substring(x, o + 1, 3) = 'ATG')"""


@query(f"""with {_SPLICED} select chrom, min(pos) filter (o = 0) as anchor, coalesce(string_agg(cast(pos as varchar), ',' order by pos) filter (o > 0 and o % 3 = 0), '') as inframe,
 coalesce(string_agg(cast(pos as varchar), ',' order by pos) filter (o % 3 <> 0), '') as outframe from found group by chrom""")
def codon_sites(spark: SparkSession, sf: str) -> DataFrame:
    """Transcripts of two blocks on either strand, from tiles that are shorter than most blocks."""
    at, n, plus = col("p"), F.char_length("seq").cast("long"), col("strand") == "+"
    # written once: expressions over it would each evaluate the text again
    genome = stored(s.genome(spark, sf), "genome")
    placed = genome.withColumn("strand", F.when(col("doc_id") % 2 == 0, "+").otherwise("-"))
    placed = placed.withColumn("p", F.instr("seq", F.when(plus, "ATG").otherwise("CAT")).cast("long") - 1).filter("p >= 0")
    low = F.struct(F.when(plus, at).otherwise(F.greatest(lit(0), at - 300)).alias("start"), F.when(plus, F.least(n, at + 300)).otherwise(at + 3).alias("end"), lit(0).alias("phase"))
    high = F.struct(F.when(plus, at + 400).otherwise(at + 100).alias("start"), F.least(n, at + 900).alias("end"), lit(0).alias("phase"))
    whole = placed.select("chrom", col("chrom").alias("transcript_id"), "strand", q.trimmed_blocks(F.array(low, high), col("strand")).alias("blocks"))
    found = transcripts.codon_sites(whole, windows.tile_genome(genome, 128, 2), tile=128)
    return found.select("chrom", "anchor", *(F.array_join(F.transform(c, lambda p: p.cast("string")), ",").alias(c) for c in ("inframe", "outframe")))


@query(f"""with {s.ANNOTATION} select event_id, regexp_extract(attrs, 'gene_id "([^"]*)"', 1) as gene_id, regexp_extract(attrs, 'transcript_id "([^"]*)"', 1) as transcript_id,
 'basic' as tag, '2' as level, contains(attrs, 'tag "click"') or contains(attrs, 'tag "view"') as tagged from annotation""")
def parse_attributes_map(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.annotation(spark, sf).withColumn("m", parse_attributes(col("attrs")))
    fields = [F.element_at("m", lit(k)).alias(k) for k in ("gene_id", "transcript_id", "tag", "level")]
    return rows.select("event_id", *fields, has_tag(col("attrs"), "click", "view").alias("tagged"))


_GENES = f"""{s.REGIONS}, genes as (select 'tx' || cast(ord as varchar) as name, chrom, strand, s as ts, s + 1000 + (ord * 13) % 500 as te, s + 100 + (ord * 7) % 200 as cs, s + 700 as ce from regions),
 exons as (select *, k, ts + 300 * k as es, ts + 300 * k + 150 + k * 20 as ee from genes, (select unnest([0, 1, 2, 3]) as k)),
 sides as (select *, 'utr5' as utr, case when strand = '+' then ts else ce end as lo, case when strand = '+' then cs else te end as hi from exons
           union all select *, 'utr3', case when strand = '+' then ce else ts end, case when strand = '+' then te else cs end from exons)"""


@query(f"""with {_GENES} select chrom, greatest(es, lo) as "start", least(ee, hi) as "end", name || '_' || utr || '_' || cast(k as varchar) as name, strand, utr from sides where greatest(es, lo) < least(ee, hi)""")
def derive_utr(spark: SparkSession, sf: str) -> DataFrame:
    at, o = col("start"), col("ord")
    genes = s.regions(spark, sf).select(
        F.concat(lit("tx"), o.cast("string")).alias("name"), "chrom", "strand", at.alias("tx_start"), (at + 1000 + (o * 13) % 500).alias("tx_end"),
        (at + 100 + (o * 7) % 200).alias("cds_start"), (at + 700).alias("cds_end"), F.array(*(at + 300 * k for k in range(4))).alias("exon_starts"),
        F.array(*(at + 300 * k + 150 + 20 * k for k in range(4))).alias("exon_ends"),
    )
    return readers.derive_utr(genes).drop("score")


@query("""with names as (select distinct unnest(list_filter(regexp_split_to_array(replace(text, ',', ' '), '\\s+'), lambda x: x <> '')[2:]) as name from benchmark),
 words as (select doc_id, regexp_extract(text, '[A-Za-z]+', 0) as name from documents)
 select doc_id, name from words where name not in (select name from names)""")
def exclusion_filter(spark: SparkSession, sf: str) -> DataFrame:
    blocked = readers.exclusion_names(s.table(spark, sf, "benchmark").select(col("text").alias("line")))
    words = s.table(spark, sf, "documents").select("doc_id", F.regexp_extract("text", "[A-Za-z]+", 0).alias("name"))
    return words.join(blocked, "name", "left_anti").select("doc_id", "name")


@query("select doc_id, octet_length(encode(text)) as length, sha256(text) as sha256 from documents")
def digest(spark: SparkSession, sf: str) -> DataFrame:
    raw = col("text").cast("binary")
    return s.table(spark, sf, "documents").select("doc_id", F.octet_length("text").cast("long").alias("length"), F.sha2(raw, 256).alias("sha256"))


# ---- nearest ----

_NEAR = f"{s.REGIONS}, anchors as (select ord, chrom, s as pos from regions where category = '1-URGENT'), sites as (select distinct chrom, e as pos from regions where category = '5-LOW')"


def _near_sql(least: int, most: str) -> str:
    return f"""with {_NEAR}, sides as (
  select a.ord, a.chrom, a.pos, (select min(x.pos) from sites x where x.chrom = a.chrom and x.pos >= a.pos + {least}) - a.pos as r,
         a.pos - (select max(x.pos) from sites x where x.chrom = a.chrom and x.pos <= a.pos - {least}) as l from anchors a),
 near as (select ord, pos, case when r <= {most} then r end as r, case when l <= {most} then l end as l from sides),
 picked as (select ord, pos, case when l is null or r <= l then r else -l end as d from near)
 select ord, pos, pos + d as near_pos, d as near_delta from picked"""


def _nearest(spark: SparkSession, sf: str, least: int, most: int | None) -> DataFrame:
    r = s.regions(spark, sf)
    anchors = r.filter("category = '1-URGENT'").select("ord", "chrom", col("start").alias("pos"))
    sites = r.filter("category = '5-LOW'").select("chrom", col("end").alias("pos"))
    return nearest.nearest_at_distance(anchors, sites, least, most).select("ord", "pos", "near_pos", "near_delta")


@query(_near_sql(200, "500"))
def nearest_at_distance(spark: SparkSession, sf: str) -> DataFrame:
    return _nearest(spark, sf, 200, 500)


@query(_near_sql(10000, "1000000000"))
def nearest_beyond_distance(spark: SparkSession, sf: str) -> DataFrame:
    return _nearest(spark, sf, 10_000, None)


@query(f"""with {_MOTIF}, anchors as (select chrom, (doc_id * 7919) % length(seq) as anchor from genome where length(seq) > 0),
 ranked as (select a.chrom, a.anchor, h.pos, row_number() over (partition by a.chrom order by abs(h.pos - a.anchor), h.pos) as k from anchors a join hits h on h.chrom = a.chrom)
 select a.chrom, a.anchor, r.pos as near_pos, r.pos - a.anchor as near_delta from anchors a left join ranked r on r.chrom = a.chrom and r.k = 1""")
def nearest_in_list(spark: SparkSession, sf: str) -> DataFrame:
    n = F.char_length("seq").cast("long")
    rows = s.genome(spark, sf).filter(n > 0).select("chrom", ((col("doc_id") * 7919) % n).alias("anchor"), q.motif_positions(col("seq")).alias("v"))
    found = rows.withColumn("x", nearest.nearest_in_list(col("anchor"), col("v")))
    return found.select("chrom", "anchor", col("x.pos").alias("near_pos"), col("x.delta").alias("near_delta"))


# ---- selection and controls ----


@query(f"with {s.REGIONS} select ord, row_number() over (order by s, ord) - 1 as pair_id from regions")
def dense_pair_id(spark: SparkSession, sf: str) -> DataFrame:
    return controls.dense_pair_id(s.regions(spark, sf), "start", "ord").select("ord", "pair_id")


@query(f"""with {s.REGIONS}, f as (select *, case when strand = '-' then e + 2000 else s - 2000 - (e - s) end as a, case when strand = '-' then e + 2000 + (e - s) else s - 2000 end as b from regions),
 free as (select * from f where a >= 0 and b <= 40200 and not exists (select 1 from regions x where x.category = f.category and x.chrom = f.chrom and x.s < f.b and f.a < x.e)),
 numbered as (select *, row_number() over (order by category, ord) - 1 as pair_id from free)
 select chrom, s as "start", e as "end", name, category, strand, pair_id from numbered
 union all select chrom, a, b, name || '_up', category || '_upstream', strand, pair_id from numbered""")
def upstream_controls(spark: SparkSession, sf: str) -> DataFrame:
    anchors, flanks = controls.upstream_controls(s.regions(spark, sf), s.lengths(spark, sf), ["category", "ord"])
    columns = ["chrom", "start", "end", "name", "category", "strand", "pair_id"]
    return anchors.select(*columns).unionByName(flanks.select(*columns))


@query(f"with {s.REGIONS} select ord, category from (select *, row_number() over (partition by category order by (ord * 7919) % 10007, ord) as k from regions) where k <= 100")
def limit_per_category(spark: SparkSession, sf: str) -> DataFrame:
    return selection.limit_per_category(s.regions(spark, sf), 100, (col("ord") * 7919) % 10007, col("ord")).select("ord", "category")


@query(f"""with {s.REGIONS} select chrom, s as "start", e as "end", strand, category, ord, name
 from (select *, row_number() over (partition by chrom order by md5('42|' || cast(ord as varchar)), ord) as k from regions) where k <= 50""")
def sample_per_contig(spark: SparkSession, sf: str) -> DataFrame:
    return selection.sample_per_contig(s.regions(spark, sf), 50, 42, "ord")


_CATEGORIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _ranked_regions(spark: SparkSession, sf: str) -> DataFrame:
    place = F.array_position(F.array(*map(F.lit, _CATEGORIES)), col("category")).cast("int")
    return s.regions(spark, sf).withColumn("category_ord", place).withColumn("rank", selection.hash_rank(42, "ord"))


def _greedy_sql(limit: int) -> str:
    """A stage for each category: rows free of what is kept so far, folded along each contig by rank, and the first of them by rank."""
    steps = [f"{s.REGIONS}, ranked as (select *, md5('42|' || cast(ord as varchar)) as rank from regions)", "kept0 as (select chrom, s, e, ord from regions where false)"]
    for k, category in enumerate(_CATEGORIES, 1):
        steps.append(f"""pool{k} as (select * from ranked r where category = '{category}' and not exists (select 1 from kept{k - 1} x where x.chrom = r.chrom and x.s < r.e and r.s < x.e)),
 folded{k} as (select chrom, list_reduce(list([{{'s': s, 'e': e, 'ord': ord, 'rank': rank}}] order by rank),
   lambda a, b: case when len(list_filter(a, lambda x: x.s < b[1].e and b[1].s < x.e)) > 0 then a else list_concat(a, b) end) as f from pool{k} group by chrom),
 first{k} as (select chrom, u.s as s, u.e as e, u.ord as ord from (select chrom, unnest(f) as u from folded{k}) order by u.rank limit {limit}),
 kept{k} as (select * from kept{k - 1} union all select * from first{k})""")
    place = " ".join(f"when '{c}' then {k}" for k, c in enumerate(_CATEGORIES, 1))
    return f"""with {", ".join(steps)} select chrom, s as "start", e as "end", strand, category, ord, name, cast(case category {place} end as integer) as category_ord, rank
 from ranked join (select ord from kept{len(_CATEGORIES)}) using (ord)"""


@query(_greedy_sql(400))
def greedy_nonoverlap(spark: SparkSession, sf: str) -> DataFrame:
    return selection.greedy_nonoverlap(_ranked_regions(spark, sf), list(_CATEGORIES), 400)


@query()
def random_controls(spark: SparkSession, sf: str) -> DataFrame:
    kept = greedy_nonoverlap(spark, sf)
    anchors = controls.dense_pair_id(kept, "category_ord", "rank")
    return controls.random_controls(anchors, s.lengths(spark, sf), 42, 200)


_AUTOSOMES = "contigs as (select 'chr' || cast(k as varchar) as chrom, k from (select unnest(range(1, 23)) as k))"


@query(f"""with {s.REGIONS}, {_AUTOSOMES}, counts as (select chrom, count(*) as n from regions group by 1)
 select c.chrom, cast(220 // 22 as bigint) as quota, n as available from contigs c join counts using (chrom)""")
def even_sample_quota(spark: SparkSession, sf: str) -> DataFrame:
    counted = s.regions(spark, sf).groupBy("chrom").agg(F.count("*").alias("available")).filter(col("chrom").isin(*AUTOSOMES))
    quotas = selection.even_quotas({r["chrom"]: r["available"] for r in counted.collect()}, 220)
    quota = F.element_at(F.create_map(*[x for c, n in quotas.items() for x in (lit(c), lit(n).cast("long"))]), col("chrom"))
    return counted.withColumn("quota", quota)


@query(f"""with {s.REGIONS}, {_AUTOSOMES}, ranked as (select r.ord, r.chrom, k, row_number() over (partition by r.chrom order by (ord * 7919) % 10007, ord) as place from regions r join contigs using (chrom))
 select ord, chrom from ranked where place <= 230 // 22 + case when k - 1 < 230 % 22 then 1 else 0 end""")
def even_sample(spark: SparkSession, sf: str) -> DataFrame:
    return selection.even_sample(s.regions(spark, sf), 230, (col("ord") * 7919) % 10007, col("ord")).select("ord", "chrom")


@query(f"with {s.REGIONS} select ord, row_number() over (order by cast(ord as varchar)) as place from regions")
def lexical_sort(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.regions(spark, sf).withColumn("key", col("ord").cast("string"))
    return controls.dense_pair_id(rows, "key", name="n").select("ord", (col("n") + 1).alias("place"))


# ---- pairs ----


@query(f"""with {s.ROLE_ROWS} select category, pair_id, role as label, chrom, s as "start", e as "end", strand, name from last_rows join complete using (category, pair_id) where role in ('feature', 'upstream')""")
def role_join_binary(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.binary_rows(s.role_rows(spark, sf), "upstream").select("category", "pair_id", "label", "chrom", "start", "end", "strand", "name")


@query(f"""with {s.ROLE_ROWS} select category, pair_id, category as label, chrom, s as "start", e as "end", strand, name from last_rows join complete using (category, pair_id) where role = 'feature'""")
def multiclass_full(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.multiclass_rows(s.role_rows(spark, sf)).select("category", "pair_id", "label", "chrom", "start", "end", "strand", "name")


@query()
def multiclass_100bp(spark: SparkSession, sf: str) -> DataFrame:
    rows = pairs.multiclass_rows(s.role_rows(spark, sf)).withColumn("size", (col("end") - col("start")).cast("int"))
    first, last = stable_subspan(col("category"), col("pair_id"), lit(0), col("size"))
    return rows.withColumns({"pool_start": first, "pool_end": last}).filter("pool_start is not null")


@query(f"with {s.ROLE_ROWS} select category, pair_id from complete")
def common_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.common_pairs(s.role_rows(spark, sf))


@query(f"""with {s.LABEL_TABLE}, good as (select * from wide where p2 is not null and p4 is not null),
 tall as (select *, 1 as k, 'start' as label, p1 as p, 0 as d from good union all select *, 2, 'noncoding_near', p2, d2 from good union all select *, 3, 'noncoding_far', p3, d3 from good
  union all select *, 4, 'inframe_methionine', p4, d4 from good union all select *, 5, 'outframe_atg', p5, d5 from good)
 select chrom, transcript_id, gene_id, strand, chrom || '|' || transcript_id || '|' || strand || '|' || cast(p1 as varchar) as pair_id, cast(k as tinyint) as label_id, label,
  cast(p as bigint) as "start", cast(d as bigint) as delta_bp, cast(p + 3 as bigint) as "end", transcript_id || '_L' || cast(k as varchar) as name from tall""")
def label_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.label_rows(pairs.complete_examples(s.label_table(spark, sf)))


@query(f"with {s.LABEL_TABLE} select transcript_id, p1 as label1_start_pos, p2 as label2_noncoding_near_pos from wide where p2 is not null and p4 is not null")
def complete_examples(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.complete_examples(s.label_table(spark, sf)).select("transcript_id", "label1_start_pos", "label2_noncoding_near_pos")


@query(f"with {s.REGIONS} select chrom, s % 500 as k from regions where category = '1-URGENT' intersect select chrom, s % 500 from regions where category = '5-LOW'")
def intersect_keys(spark: SparkSession, sf: str) -> DataFrame:
    r = s.regions(spark, sf).withColumn("k", col("start") % 500)
    return pairs.intersect_keys([r.filter("category = '1-URGENT'"), r.filter("category = '5-LOW'")], "chrom", "k")


@query(f"with {s.REGIONS} select chrom, s % 500 as k from regions where category = '1-URGENT' union select chrom, s % 500 from regions where category = '5-LOW'")
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    r = s.regions(spark, sf).withColumn("k", col("start") % 500)
    return pairs.union_distinct([r.filter(f"category = '{c}'").select("chrom", "k") for c in ("1-URGENT", "5-LOW")])


@query(f"""with {s.REGIONS}, a as (select chrom, s % 50 as k from regions where category = '1-URGENT'), b as (select chrom, s % 50 as k from regions where category = '5-LOW')
 select chrom, k, 'a' as side from (select * from a except all select * from b) union all select chrom, k, 'b' from (select * from b except all select * from a)""")
def differing_rows(spark: SparkSession, sf: str) -> DataFrame:
    r = s.regions(spark, sf).withColumn("k", col("start") % 50)
    return checks.differing_rows(*(r.filter(f"category = '{c}'").select("chrom", "k") for c in ("1-URGENT", "5-LOW")))


# ---- score statistics ----

_STATS = """round(avg(x), 8) as mean, round(stddev_pop(x), 8) as std, round(avg(case when x > 0 then 1.0::double else 0 end), 8) as frac_pos,
 round(avg(case when x < 0 then 1.0::double else 0 end), 8) as frac_neg, round(coalesce(avg(case when x > 0 then x end), 0), 8) as mean_pos, round(coalesce(avg(case when x < 0 then x end), 0), 8) as mean_neg"""
_BASES = "bases as (select span_id, coalesce(score, 0) as x from (select span_id, chrom, unnest(range(rs, re)) as p from spans) b left join track t on t.chrom = b.chrom and t.pos = b.p)"


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("span_id", *(F.round(c, 8).alias(c) for c in df.columns if c != "span_id"))


@query(f"with {s.SCORE_SPANS}, spans as (select *, {_ROI} from score_spans), {_BASES} select span_id, {_STATS} from bases group by span_id")
def score_stats_roi(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.score_spans(spark, sf)
    names = ("scope", "n", "start", "end", "strand", "context_start", "context_end", "pool_start", "pool_end")
    low, high = g.baseline_roi_span(*(col(c) for c in names))
    return _rounded(signal.score_stats(rows.select("span_id", "chrom", low.alias("start"), high.alias("end")), s.track(spark, sf)))


@query(f"with {s.SCORE_SPANS}, spans as (select *, 0 as rs, n + 5 as re from score_spans), {_BASES} select span_id, {_STATS} from bases group by span_id")
def score_stats_context(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.score_spans(spark, sf)
    low, high = g.context_bounds(col("n") + 5, col("start"), col("end"), col("strand"), policy="symmetric")
    return _rounded(signal.score_stats(rows.select("span_id", "chrom", low.alias("start"), high.alias("end")), s.track(spark, sf)))


@query()
def score_stats_exact(spark: SparkSession, sf: str) -> DataFrame:
    return signal.exact_score_stats(s.score_spans(spark, sf), s.track(spark, sf))


@query(f"with {s.SCORE_SPANS} select span_id, pos - s as at, cast(1 as bigint) as bases, score as value from score_spans p join track t on t.chrom = p.chrom and t.pos >= p.s and t.pos < p.e")
def signal_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return signal.signal_lookup(s.score_spans(spark, sf), s.track(spark, sf))


@query("select event_id, round_even((value - 245) * 100, 0) / 100 as score from events")
def round_score(spark: SparkSession, sf: str) -> DataFrame:
    return s.table(spark, sf, "events").select("event_id", signal.round_score(col("value") - 245).alias("score"))


# ---- checks ----


@query(f"""with {s.ROLE_ROWS} select category, pair_id, array_to_string(list_sort(list(distinct role)), ',') as labels, count(*) as n_rows from role_rows where role in ('feature', 'upstream')
 group by 1, 2 having not (count(*) = 2 and count(distinct role) = 2)""")
def validate_pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.role_rows(spark, sf).filter("role in ('feature', 'upstream')").withColumn("label", col("role"))
    return checks.wrong_pairs(rows, ["feature", "upstream"]).withColumn("labels", F.array_join("labels", ","))


@query(f"with {s.ROLE_ROWS} select category, role, pair_id, count(*) as n_rows from role_rows group by 1, 2, 3 having count(*) > 1")
def validate_unique(spark: SparkSession, sf: str) -> DataFrame:
    return checks.repeated_keys(s.role_rows(spark, sf), "category", "role", "pair_id")


@query(f"with {s.ROLE_ROWS} select category, pair_id, array_to_string(list_sort(list(distinct role)), ',') as labels, count(*) as n_rows from role_rows group by 1, 2")
def label_set_per_pair(spark: SparkSession, sf: str) -> DataFrame:
    return checks.label_sets(s.role_rows(spark, sf).withColumn("label", col("role"))).withColumn("labels", F.array_join("labels", ","))


@query(f"with {s.ROLE_ROWS} select category, role, count(*) as n_rows from role_rows group by 1, 2")
def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.row_counts(s.role_rows(spark, sf), "category", "role")


@query(f"""{_window_sql(_CAUSAL.format(n="n"), "causal").replace("select 'train' as split", ", final as (select 'train' as split", 1)})
 select count(*) as n_rows, count(*) filter (length(sequence) not between 1 and 2048) as bad_length, count(*) filter (roi_start < 0 or roi_start >= roi_end) as bad_roi,
  count(*) filter (pool_start < 0 or pool_start >= pool_end or pool_end > length(sequence)) as bad_pool, count(*) filter (pool_start < roi_start or pool_end > roi_end) as pool_outside_roi,
  count(*) filter (context_policy <> 'causal') as bad_policy from final""")
def validate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return checks.row_violations(context_window_causal(spark, sf), "causal")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strand-oriented windows of the surrogate regions as rows of the fixed schema."""
    return context_window_causal(spark, sf_dir)

"""Deterministic stand-ins for genomic inputs, made from the driver's tables; each has a SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import letters_as_bases

CONTIG_LENGTH = 40_200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def genome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contig for each document: its letters as bases."""
    bases = letters_as_bases(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("chrom"), bases.alias("seq"))


GENOME = """genome as (
  select doc_id, 'doc' || cast(doc_id as varchar) as chrom,
         translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTNN') as seq
  from documents)"""


def _contig(key: Column) -> Column:
    k = 1 + key % 23
    return F.concat(F.lit("chr"), F.when(k == 23, F.lit("X")).otherwise(k.cast("string")))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An interval for each order, on 23 contigs of 40,200 bases."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    start = (key * 7919) % 40000
    strand = F.when(F.col("o_orderstatus") == "F", "+").when(F.col("o_orderstatus") == "O", "-").otherwise(".")
    return table(spark, sf_dir, "orders").select(
        _contig(key).alias("chrom"), start.alias("start"), (start + 20 + (cust * 31) % 180).alias("end"), strand.alias("strand"),
        F.col("o_orderpriority").alias("category"), key.alias("ord"), F.concat(F.lit("r"), key.cast("string")).alias("name"),
    )


REGIONS = """regions as (
  select 'chr' || case when 1 + o_orderkey % 23 = 23 then 'X' else cast(1 + o_orderkey % 23 as varchar) end as chrom,
         (o_orderkey * 7919) % 40000 as s, (o_orderkey * 7919) % 40000 + 20 + (o_custkey * 31) % 180 as e,
         case o_orderstatus when 'F' then '+' when 'O' then '-' else '.' end as strand,
         o_orderpriority as category, o_orderkey as ord, 'r' || cast(o_orderkey as varchar) as name
  from orders)"""


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions(spark, sf_dir).select("chrom").distinct().withColumn("length", F.lit(CONTIG_LENGTH).cast("long"))


def doc_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four intervals for each contig of ``genome``, on all three strands."""
    sized = genome(spark, sf_dir).select("doc_id", "chrom", F.char_length("seq").cast("long").alias("n")).filter("n > 0")
    rows = sized.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))))
    start = (F.col("doc_id") * 7919 + F.col("j") * 104729) % F.col("n")
    turn = (F.col("doc_id") + F.col("j")) % 3
    return rows.withColumn("start", start).select(
        "chrom", "start", F.least(F.col("n"), F.col("start") + 1 + (F.col("doc_id") * 31 + F.col("j") * 17) % 300).alias("end"),
        F.when(turn == 0, "+").when(turn == 1, "-").otherwise(".").alias("strand"), (F.col("doc_id") * 4 + F.col("j")).alias("pair_id"),
        F.lit("doc").alias("category"), F.concat(F.lit("d"), (F.col("doc_id") * 4 + F.col("j")).cast("string")).alias("name"),
    )


DOC_REGIONS = f"""{GENOME},
 doc_regions as (
  select chrom, seq, n, s, least(n, s + 1 + (doc_id * 31 + j * 17) % 300) as e,
         case (doc_id + j) % 3 when 0 then '+' when 1 then '-' else '.' end as strand, doc_id * 4 + j as pair_id
  from (select *, (doc_id * 7919 + j * 104729) % n as s
        from (select doc_id, chrom, seq, length(seq) as n from genome where length(seq) > 0), (select unnest([0, 1, 2, 3]) as j)))"""


def role_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the four roles of pairs; some rows have another role, so that pairs lack one, and features may be given twice."""
    k = F.col("ord") % 5
    role = F.when((F.col("ord") * 7) % 11 == 0, "spare").when(k == 1, "upstream").when(k == 2, "random").when(k == 3, "random-noannot").otherwise("feature")
    pair = F.floor(F.col("ord") / 5)
    return regions(spark, sf_dir).select(
        F.concat(F.lit("c"), (pair % 3).cast("string")).alias("category"), pair.cast("string").alias("pair_id"), role.alias("role"),
        "chrom", "start", "end", "strand", "name", "ord",
    )


ROLE_ROWS = f"""{REGIONS},
 role_rows as (
  select 'c' || cast((ord // 5) % 3 as varchar) as category, cast(ord // 5 as varchar) as pair_id,
         case when (ord * 7) % 11 = 0 then 'spare' when ord % 5 = 1 then 'upstream' when ord % 5 = 2 then 'random' when ord % 5 = 3 then 'random-noannot' else 'feature' end as role,
         chrom, s, e, strand, name, ord
  from regions),
 last_rows as (select * from (select *, row_number() over (partition by category, pair_id, role order by ord desc) as k from role_rows) where k = 1),
 complete as (select category, pair_id from last_rows where role <> 'spare' group by 1, 2 having count(*) = 4)"""


def track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contig of single-base scores for each user, with both signs."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("chrom"), place.cast("long").alias("start"), (place + 1).cast("long").alias("end"),
        (F.col("value") - 245).alias("value"), "user_id",
    )


TRACK = """track as (
  select 'u' || cast(user_id as varchar) as chrom, user_id,
         row_number() over (partition by user_id order by ts, event_id) - 1 as pos, round_even((value - 245) * 100, 0) / 100 as score
  from events)"""


def score_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three dataset-like rows for each user, of scopes ``full`` and ``100bp``, on contigs of as many bases as the user has events."""
    users = track(spark, sf_dir).groupBy("chrom", "user_id").agg(F.count("*").alias("n"))
    rows = users.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))))
    start = (F.col("user_id") * 13 + F.col("j") * 17) % F.col("n")
    rows = rows.withColumn("start", start).withColumn("end", F.least(F.col("n"), F.col("start") + 3 + (F.col("user_id") * 7 + F.col("j")) % 25))
    return rows.select(
        F.concat_ws("-", "chrom", F.col("j").cast("string")).alias("span_id"), "chrom", "n", "start", "end",
        F.when(F.col("j") == 1, "-").otherwise("+").alias("strand"), F.when(F.col("j") == 2, "100bp").otherwise("full").alias("scope"),
        F.lit(0).cast("long").alias("context_start"), F.col("n").alias("context_end"),
        F.col("start").alias("pool_start"), (F.col("start") + 1).alias("pool_end"),
    )


SCORE_SPANS = f"""{TRACK},
 score_spans as (
  select chrom || '-' || cast(j as varchar) as span_id, chrom, n, s, least(n, s + 3 + (user_id * 7 + j) % 25) as e,
         case when j = 1 then '-' else '+' end as strand, case when j = 2 then '100bp' else 'full' end as scope
  from (select *, (user_id * 13 + j * 17) % n as s
        from (select chrom, user_id, count(*) as n from track group by 1, 2), (select unnest([0, 1, 2]) as j)))"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four coding segments with phases for each order, as an array."""
    part = lambda k: F.struct(
        (F.col("start") + 200 * k).alias("start"), (F.col("start") + 200 * k + (F.col("ord") * (k + 3)) % 90).alias("end"),
        ((F.col("ord") + k) % 4).cast("int").alias("phase"),
    )
    return regions(spark, sf_dir).filter("strand <> '.'").select("ord", "chrom", "strand", F.array(*map(part, range(4))).alias("segments"))


BLOCKS = f"""{REGIONS},
 segments as (
  select ord, strand, s + 200 * k as s, s + 200 * k + (ord * (k + 3)) % 90 as e, (ord + k) % 4 as phase, k
  from regions, (select unnest([0, 1, 2, 3]) as k) where strand <> '.'),
 placed as (select *, row_number() over (partition by ord order by case when strand = '-' then -k else k end) as place from segments),
 trimmed as (
  select ord, strand, place,
         case when strand <> '-' and place = 1 and phase < 3 then least(e, s + phase) else s end as s,
         case when strand = '-' and place = 1 and phase < 3 then greatest(s, e - phase) else e end as e
  from placed),
 blocks as (
  select ord, strand, s, e, cast(coalesce(sum(e - s) over (partition by ord order by place rows between unbounded preceding and 1 preceding), 0) as bigint) as o
  from trimmed where s < e)"""


def label_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows of five positions, some missing."""
    r = regions(spark, sf_dir)
    gone = lambda k, c: F.when(F.col("ord") % k != 0, c)
    s = F.col("start")
    return r.select(
        "chrom", F.concat(F.lit("t"), F.col("ord").cast("string")).alias("transcript_id"), F.concat(F.lit("g"), (F.col("ord") % 97).cast("string")).alias("gene_id"), "strand",
        s.alias("label1_start_pos"), gone(3, s + 2100).alias("label2_noncoding_near_pos"), gone(3, F.lit(2100).cast("long")).alias("label2_delta_bp"),
        (s + 100_000).alias("label3_noncoding_far_pos"), F.lit(100_000).cast("long").alias("label3_delta_bp"),
        gone(5, s + 33).alias("label4_same_inframe_met_pos"), gone(5, F.lit(33).cast("long")).alias("label4_delta_bp"),
        (s - 7).alias("label5_same_outframe_atg_pos"), F.lit(-7).cast("long").alias("label5_delta_bp"),
    )


LABEL_TABLE = f"""{REGIONS},
 wide as (
  select chrom, 't' || cast(ord as varchar) as transcript_id, 'g' || cast(ord % 97 as varchar) as gene_id, strand, s as p1,
         case when ord % 3 <> 0 then s + 2100 end as p2, case when ord % 3 <> 0 then 2100 end as d2, s + 100000 as p3, 100000 as d3,
         case when ord % 5 <> 0 then s + 33 end as p4, case when ord % 5 <> 0 then 33 end as d4, s - 7 as p5, -7 as d5
  from regions)"""


def annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attribute list for each event."""
    c = lambda x: F.col(x).cast("string")
    text = F.concat(
        F.lit('gene_id "g'), c("user_id"), F.lit('"; transcript_id "t'), c("event_id"), F.lit('"; tag "'), F.col("event_type"), F.lit('"; level 2; tag "basic";')
    )
    return table(spark, sf_dir, "events").select("event_id", "event_type", text.alias("attrs"))


ANNOTATION = """annotation as (
  select event_id, event_type,
         'gene_id "g' || cast(user_id as varchar) || '"; transcript_id "t' || cast(event_id as varchar) || '"; tag "' || event_type || '"; level 2; tag "basic";' as attrs
  from events)"""

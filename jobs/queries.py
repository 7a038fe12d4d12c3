"""The jobs as queries: each runs twice into one new folder and returns its whole output, beside the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stranda.queries.surrogates import GENOME
from stranda.sources.scratch import scratch_path

from . import motif_pairs, score_tracks
from .config import load


def job1_motif_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "job1")
    for _ in range(2):
        motif_pairs.run(spark, f"{sf_dir}/documents.parquet", out, load(None, "motif_pairs.toml"))
    return motif_pairs.read(spark, out)


def job2_score_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "job2")
    for _ in range(2):
        score_tracks.run(spark, f"{sf_dir}/events.parquet", f"{out}/data", f"{out}/checkpoint", load(None, "score_tracks.toml"))
    return score_tracks.read(spark, f"{out}/data")


_SITES = " union all ".join(
    f"select chrom, n, '{strand}' as strand, pos as s, pos + 6 as e from (select chrom, seq, n, unnest(range(n - 5)) as pos from contigs where n > 5) where substring(seq, pos + 1, 6) = '{motif}'"
    for strand, motif in (("+", "TATAAA"), ("-", "TTTATA"))
)
_BOUNDS = """select *, 'causal' as policy, case when strand = '+' then greatest(0, e - 512) else s end as cs, case when strand = '+' then e else least(n, s + 512) end as ce,
   from placed union all select *, 'symmetric', greatest(0, least(n, greatest(0, (s + e) // 2 - 256) + 512) - 512), least(n, greatest(0, (s + e) // 2 - 256) + 512) from placed"""

MOTIF_PAIRS_SQL = f"""with {GENOME},
 contigs as (select chrom, seq, length(seq) as n from genome where seq <> ''),
 sites as ({_SITES}),
 numbered as (select *, sum(case when s > reached or reached is null then 1 else 0 end) over (partition by chrom, strand order by s rows unbounded preceding) as island
  from (select *, lag(e) over (partition by chrom, strand order by s) as reached from sites)),
 features as (select chrom, n, strand, min(s) as s, max(e) as e from numbered group by chrom, n, strand, island),
 flanks as (select *, case when strand = '-' then e + 200 else s - 200 - (e - s) end as a, case when strand = '-' then e + 200 + (e - s) else s - 200 end as b from features),
 free as (select * from flanks f where a >= 0 and b <= n and not exists (select 1 from features x where x.chrom = f.chrom and x.s < f.b and f.a < x.e)),
 pairs as (select *, chrom || ':' || cast(s as varchar) || ':' || strand as name, row_number() over (order by chrom, s, strand) - 1 as pair_id from free),
 placed as (select chrom, n, strand, s, e, name, pair_id, 'feature' as label from pairs union all select chrom, n, strand, a, b, name || '_up', pair_id, 'upstream' from pairs),
 framed as ({_BOUNDS}),
 cut as (select f.*, substring(seq, cs + 1, ce - cs) as piece, greatest(0, s - cs) as a, least(ce - cs, e - cs) as b, ce - cs as size from framed f join contigs using (chrom)),
 turned as (select *, cast(case when strand = '-' then size - b else a end as integer) as first, cast(case when strand = '-' then size - a else b end as integer) as last from cut)
 select case when cast(substring(chrom, 4) as bigint) % 10 = 0 then 'test' else 'train' end as split,
  case when strand = '-' then reverse(translate(piece, 'ACGTN', 'TGCAN')) else piece end as sequence, label, cast(pair_id as varchar) as pair_id, 'promoters' as category, 'full' as scope,
  policy as context_policy, chrom, s as "start", e as "end", strand, cs as context_start, ce as context_end, first as roi_start, last as roi_end, first as pool_start, last as pool_end, name
 from turned"""

SCORE_TRACKS_SQL = """with records as (select 'u' || cast(user_id as varchar) as chrom, event_id // 1000 as w, cast(round_even((value - 245.0) * 100, 0) as bigint) as x from events
   where event_id is not null and user_id is not null and value is not null and not isnan(value) and abs(value) < 1e9),
 sums as (select chrom, w, count(*) as n, sum(x) as s, sum(x * x) as ss, cast(count(*) filter (x > 0) as double) as np, cast(count(*) filter (x < 0) as double) as nn,
   cast(coalesce(sum(x) filter (x > 0), 0) as double) as sp, cast(coalesce(sum(x) filter (x < 0), 0) as double) as sn from records group by 1, 2)
 select chrom, w * 1000 as "start", w * 1000 + 1000 as "end", n as n_records, cast(s as double) / 100 / 1000 as mean,
  sqrt(cast(1000 * ss - s * s as double)) / 1000 / 100 as std, np / 1000.0::double as frac_pos, nn / 1000.0::double as frac_neg,
  case when np > 0 then sp / 100 / np else 0 end as mean_pos, case when nn > 0 then sn / 100 / nn else 0 end as mean_neg from sums"""

QUERIES = {"job1_motif_pairs": job1_motif_pairs, "job2_score_tracks": job2_score_tracks}
ORACLES = {"job1_motif_pairs": MOTIF_PAIRS_SQL, "job2_score_tracks": SCORE_TRACKS_SQL}

"""Texts read as bases, and sites outside intervals joined once."""

import random

from pyspark.sql import functions as F

from stranda.functions.sequence import letters_as_bases, motif_positions
from stranda.operators.intervals import outside_intervals
from stranda.operators.windows import motif_scan, tile_genome


def test_letters_as_bases_is_what_pattern_and_translation_give(spark):
    texts = ["Az yZ 09_-!\n\t\\[]^`{}~", "é ß İ ſ K Ünïcode \U0001f600 'Ll x's", "", None, "\x00a\x7fb", "x" * 3000]
    plain = F.translate(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTNN")
    for r in spark.createDataFrame([(x,) for x in texts], "text string").select(plain.alias("a"), letters_as_bases(F.col("text")).alias("b")).collect():
        assert r.a == r.b


def test_positions_split_the_text_once(spark):
    df = spark.createDataFrame([("ATGCATGATG",), ("",), (None,), ("CC",)], "seq string").select(motif_positions(F.col("seq")).alias("at"))
    assert [r.at for r in df.collect()] == [[0, 4, 7], [], None, []]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 1


def test_sites_outside_intervals_are_read_once(spark):
    rng = random.Random(3)
    spans = [("a", s, s + rng.choice((1, 2, 3, 9, 300, 40_000))) for s in (rng.randrange(200_000) for _ in range(60))] + [("b", 0, 700_000)]
    sites = [(rng.choice("abc"), rng.randrange(250_000), k) for k in range(800)] * 2 + [(None, 5, -1), ("a", None, -2)]
    df = spark.createDataFrame(sites, "chrom string, pos long, k long")
    covered = {}
    for c, s, e in sorted(spans):
        last = covered.setdefault(c, [])
        if last and s <= last[-1][1]:
            last[-1][1] = max(last[-1][1], e)
        else:
            last.append([s, e])
    inside = lambda c, p: p is not None and any(s <= p and p + 3 <= e for s, e in covered.get(c, []))
    got = outside_intervals(df, spark.createDataFrame(spans, "chrom string, start long, end long"), bin_size=64)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr(x) for x in sites if not inside(*x[:2]))
    hits = motif_scan(tile_genome(spark.createDataFrame([("a", "CCATGCATG")], "chrom string, seq string")))
    plan = outside_intervals(hits, spark.createDataFrame(spans, "chrom string, start long, end long"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan

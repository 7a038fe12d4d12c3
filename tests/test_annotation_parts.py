"""Annotation lines: what is read and taken apart once, and files that no single task writes."""

import os

import pytest
from pyspark.sql import functions as F

from stranda.functions.attributes import attribute_values, parse_attributes
from stranda.operators import transcripts
from stranda.queries import formats

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")


def test_values_of_keys_are_those_of_the_map(spark):
    lists = ['gene_id "g1"; transcript_id "t 1"; tag "a"; tag "b";', 'gene_id "x"; gene_id "y";transcript_id t2', "gene_id", "", ";;", ' gene_id  "" ; transcript_id ""q""', None]
    df = spark.createDataFrame([(x,) for x in lists], "attrs string")
    keys = ("transcript_id", "gene_id", "transcript_type")
    of_map = F.struct(*(F.try_element_at(parse_attributes(F.col("attrs")), F.lit(k)).alias(k) for k in keys))
    for r in df.select(of_map.alias("a"), attribute_values(F.col("attrs"), *keys).alias("b")).collect():
        assert [r.a[k] for k in keys] == [r.b[k] if r.b else None for k in keys]
    assert df.select(attribute_values(F.col("attrs"), *keys).alias("b")).head(2)[1].b["gene_id"] == "y"


def test_features_read_the_annotation_three_times_at_most(spark, tmp_path):
    (tmp_path / "a.gtf").write_text("chr1\tx\texon\t1\t5\t.\t+\t0\tgene_id g\n")
    from stranda.sources.readers import scan_gtf

    plan = transcripts.gene_features(scan_gtf(spark, str(tmp_path / "a.gtf")))._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("Relation [value") <= 3


@needs_data
def test_annotation_is_written_in_several_files(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        lines = transcripts.annotated_lines(formats._gtf(spark, SF))
        assert lines.select("source").distinct().count() > 1
        assert lines.groupBy("transcript_id").agg(F.count_distinct("source").alias("n")).filter("n > 1").isEmpty()
    finally:
        spark.conf.unset(key)


def test_only_lines_that_count_are_kept_by_kind(spark, tmp_path):
    ids = lambda t, gene="g", kind="protein_coding": f'gene_id "{gene}"; transcript_id "{t}"; transcript_type "{kind}";'
    lines = [
        ("exon", 1, ids("early")), ("transcript", 2, ids("early")), ("exon", 3, 'transcript_id "early"'), ("CDS", 4, ids("early", kind="lncRNA")),
        ("transcript", 5, ids("rna", kind="lncRNA")), ("CDS", 6, ids("rna")), ("gene", 7, ids("rna")),
        ("transcript", 8, ids("no_gene", gene="")), ("exon", 9, ids("no_gene")), ("transcript", 10, 'gene_id "g"; transcript_id "no_type";'), ("CDS", 11, ids("no_type")),
        ("transcript", 12, ids("")), ("exon", 13, ids("")), ("exon", 14, ids("unknown")),
        ("transcript", 15, ids("twice")), ("exon", 16, ids("twice")), ("transcript", 17, ids("twice", kind="lncRNA")), ("CDS", 18, ids("twice")),
        ("transcript", 19, ids("twice", gene="")), ("exon", 20, ids("twice")),
    ]
    kept = {2: False, 3: False, 4: True, 5: False, 6: False, 17: False, 18: False, 20: False}  # by end, with whether it is a coding region
    (tmp_path / "a.gtf").write_text("".join(f"chr1\tx\t{kind}\t1\t{end}\t.\t+\t0\t{attrs}\n" for kind, end, attrs in lines))
    (tmp_path / "b.gtf").write_text(f"chr1\tx\texon\t1\t21\t.\t+\t0\t{ids('early')}\n")
    from stranda.sources.readers import scan_gtf

    rows = transcripts.feature_lines(scan_gtf(spark, str(tmp_path))).collect()
    assert sorted((r.end, r.coding) for r in rows) == sorted(kept.items())


@needs_data
def test_feature_kind_leaves_out_what_does_not_count(spark, tmp_path, monkeypatch):
    lines = [("transcript", 't"; gene_id "g"; transcript_type "lncRNA'), ("exon", "t"), ("CDS", "t"), ("transcript", 'u"; gene_id "g'), ("exon", 'u"; gene_id "g'), ("CDS", 'v"; gene_id "g')]
    (tmp_path / "a.gtf").write_text("".join(f'chr1\tx\t{kind}\t1\t5\t.\t+\t0\ttranscript_id "{rest}";\n' for kind, rest in lines))
    scan = formats.readers.scan_gtf
    monkeypatch.setattr(formats.readers, "scan_gtf", lambda spark, path: scan(spark, str(tmp_path)))
    row = formats.feature_kind(spark, SF).head().asDict()
    assert [row[n] for n in ("n_transcripts", "n_exons", "n_cds")] == [1, 1, 1]
    assert row["n_coding_regions"] == 0

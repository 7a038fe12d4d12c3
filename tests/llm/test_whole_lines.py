import random
from collections import defaultdict

from stranda.llm import queries

from .helpers import prose


def short_rows():
    """Short lines, many of them equal; some differ from others by a letter only."""
    rng = random.Random(8)
    pool = ["Menu", "menu", "Home", "Hone", "é", "x", "-", "see also", "see Also", "19 code points here"]
    return [(k, "\n".join([rng.choice(pool), prose(rng, 12), "", "  ", rng.choice(pool)])) for k in range(40)]


def equal_lines(rows):
    first, gone = {}, defaultdict(set)
    for d, t in sorted(rows):
        for k, line in enumerate(t.split("\n")):
            if line.strip() and first.setdefault(line, (d, k)) != (d, k):
                gone[d].add(k)
    return gone


def test_op2_takes_out_short_equal_lines(spark, tmp_path):
    rows = short_rows()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = equal_lines(rows)
    assert want
    assert {r.doc_id: set(r.removed) for r in queries.op2_line_dedup(spark, str(tmp_path)).collect()} == {d: want[d] for d, _ in rows}


def test_pipeline_takes_out_short_equal_lines(spark):
    import corpus_pipeline as p

    rows = short_rows()
    want = equal_lines(rows)
    cut = {r.doc_id: r.text for r in p.lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert cut == {d: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[d]) for d, t in rows}


def test_line_stage_keeps_columns_of_any_name(spark):
    import corpus_pipeline

    rows = [(1, "one line here of some words\nother line", 38, "x"), (2, "one line here of some words\nthird", 33, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, `a.b` string")
    got = {r["doc_id"]: tuple(r) for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert got == {1: rows[0], 2: (2, "third", 5, "y")}

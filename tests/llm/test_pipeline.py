import random

import pytest
from pyspark.sql import functions as F

from .helpers import prose


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    rng = random.Random(21)
    d = tmp_path_factory.mktemp("sf")
    items = [(k, prose(rng, 25)) for k in range(6)]
    boiler = prose(rng, 60)
    rows = [(k, "\n".join(prose(rng, rng.randint(15, 60)) for _ in range(4)), "en", "s", 0) for k in range(50)]
    rows += [(60 + k, rows[k][1], "en", "s", 0) for k in range(5)]
    rows += [(70 + k, " ".join([*rows[10 + k][1].replace("\n", " ").split(" ")[:-1], "end"]), "en", "s", 0) for k in range(5)]
    rows += [(80 + k, f"{prose(rng, 60)}\n{items[k][1]}\n{prose(rng, 60)}", "en", "s", 0) for k in range(6)]
    rows += [(90 + k, f"{prose(rng, 60)}\n{boiler}\n{prose(rng, 60)}", "en", "s", 0) for k in range(4)]
    rows += [(95, None, None, None, None), (96, "", "en", "s", 0), (97, "same words here\n" * 40, "en", "s", 0), (None, prose(rng, 80), "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(d / "documents.parquet"))
    spark.createDataFrame([(r[0], 1, 0) for r in rows if r[0] is not None and r[0] < 95], "doc_id long, quality int, toxic int").write.parquet(str(d / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(d / "benchmark.parquet"))
    return str(d), rows


def test_stages(spark, inputs):
    import corpus_pipeline as p

    sf, rows = inputs
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("row", F.lit("r")).withColumn("kept", F.lit("k")).withColumn("leaks", F.lit("l"))
    ids = {}
    for name, stage in p.STAGES:
        before, docs = docs, stage(spark, docs, sf)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name != "pack":
            assert docs.columns == before.columns
        ids[name] = {r.doc_id for r in docs.collect()}
    clean = set(range(50)) | set(range(90, 94)) | {None}
    assert ids["quality"] == clean | set(range(60, 65)) | set(range(70, 75)) | set(range(80, 86))
    # exact copies lose all their lines
    assert ids["line_dedup"] == ids["quality"] - set(range(60, 65))
    assert ids["near_dups"] == ids["line_dedup"] - set(range(70, 75))
    assert ids["decontaminate"] == clean
    assert ids["pack"] == clean
    assert docs.filter("offset + length > 2048").count() == 0


def test_run(spark, inputs):
    import corpus_pipeline as p

    got = p.run(spark, inputs[0]).collect()
    assert {r.doc_id for r in got} == set(range(50)) | set(range(90, 94)) | {None}


def test_empty_tables(spark, tmp_path):
    import corpus_pipeline as p

    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert p.run(spark, str(tmp_path)).collect() == []


def test_queries_are_registered():
    import __spark_entry__ as e

    names = set(e.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 11)}
    assert set(e.oracle_sql()) <= names

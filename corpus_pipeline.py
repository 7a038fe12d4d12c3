"""Training-corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, packing.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet in the shared folder and reads it again as the next stage's documents. All stages but the
last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stranda.llm.common import materialize, table
from stranda.llm.decontaminate import LEAST_WORDS, screen
from stranda.llm.line_dedup import EQUAL_CHARS, dedup_lines
from stranda.llm.near_dups import near_duplicates
from stranda.llm.packing import pack_documents
from stranda.llm.quality import quality_rules


def whole(docs: DataFrame) -> DataFrame:
    """doc_id, text and the row as one value, so that its other columns may have any names."""
    return docs.select("doc_id", "text", F.struct("*").alias("row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts go."""
    return quality_rules(whole(docs), table(spark, sf_dir, "labels"), ("row",)).filter("kept").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones; documents of which nothing else is left go. Columns may have any names."""
    cut = dedup_lines(docs, least=EQUAL_CHARS, by_words=True)
    if "n_chars" not in docs.columns:
        return cut
    names = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*names)


#: Least similarity, in percent, of documents that count as near duplicates in the pipeline.
NEAR_PERCENT = 80


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; rows with a null doc_id stay."""
    gone = near_duplicates(docs, NEAR_PERCENT).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["doc_id"], "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of the benchmark. A few words that are a whole item (LEAST_WORDS) are no leak by themselves."""
    found = screen(whole(docs), table(spark, sf_dir, "benchmark"), ("row",))
    leak = F.exists("leaks", lambda x: (x["n_words"] >= LEAST_WORDS) | (x["score"] < 1))
    return found.filter(~leak).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each token piece of each document, with its place in a packed sequence."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_dups", near_dups),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: The stages cannot be stated in SQL; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Writers: typed Parquet, trees of BED files, label tables, and folders replaced in one step."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import conform

ROW_GROUP = 2048


def write_dataset(df: DataFrame, path: str, schema: T.StructType, row_group: int = ROW_GROUP, files: int | None = None) -> int:
    """Write a dataset of a fixed schema (zstd, bounded row groups); its number of rows, counted on the way.

    The rows may come from the dataset itself: it is replaced by ``put_in_place`` when the new one is whole.
    """
    seen = Observation()
    typed = conform(df, schema).observe(seen, F.count(F.lit(1)).alias("n"))
    if files is not None:
        typed = typed.coalesce(files)
    new = f"{path.rstrip('/')}.next"
    typed.write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", str(row_group)).parquet(new)
    put_in_place(df.sparkSession, new, path)
    return seen.get["n"]


def write_bed_tree(rows: DataFrame, root: str) -> None:
    """Seven-column BED text in a folder for each category and contig; the tree replaces what was there."""
    fields = ["chrom", "start", "end", "name", "score", "strand", "pair_id"]
    line = F.concat_ws("\t", *(F.col(c).cast("string") for c in fields)).alias("value")
    keyed = rows.select(line, F.col("category").alias("_category"), F.col("chrom").alias("_contig"), "ord")
    spread = keyed.repartition("_category", "_contig").sortWithinPartitions("_category", "_contig", "ord")
    spread.select("value", F.col("_category").alias("category"), F.col("_contig").alias("contig")).write.mode("overwrite").partitionBy(
        "category", "contig"
    ).text(root)


def read_bed_partitions(spark: SparkSession, root: str) -> DataFrame:
    """Rows of a tree that ``write_bed_tree`` wrote, with category."""
    f = F.split("value", "\t", -1)
    return spark.read.text(root).select(
        F.col("category"), f[0].alias("chrom"), f[1].cast("long").alias("start"), f[2].cast("long").alias("end"), f[3].alias("name"),
        f[4].cast("double").alias("score"), f[5].alias("strand"), f[6].alias("pair_id"), F.monotonically_increasing_id().alias("ord"),
    )


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text with a header; null is ``.``."""
    df.write.mode("overwrite").option("header", "true").option("sep", "\t").option("nullValue", ".").option("emptyValue", "").csv(path)


def split_gtf(spark: SparkSession, path: str, out: str) -> None:
    """One folder of annotation lines for each ``chr`` contig; comments go, lines keep their order in the file."""
    lines = spark.read.text(path).select("value", F.split("value", "\t")[0].alias("contig"), F.monotonically_increasing_id().alias("n"))
    kept = lines.filter(F.col("contig").startswith("chr") & ~F.col("value").startswith("#"))
    kept.repartition("contig").sortWithinPartitions("contig", "n").select("value", "contig").write.mode("overwrite").partitionBy("contig").text(out)


class Store:
    """Existence, renaming and deletion of paths of one file system."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, a: str, b: str) -> None:
        if not self._fs.rename(self._path(a), self._path(b)):
            raise OSError(f"cannot rename {a} to {b}")


def put_in_place(spark: SparkSession, new: str, path: str) -> None:
    """Let the whole dataset at ``new`` take the name ``path``. What had it is set aside until the new one stands.

    Stopped at any step, the old or the new dataset is whole under ``path`` or aside, and ``standing`` finds it.
    """
    path, store = path.rstrip("/"), Store(spark, path)
    aside = f"{path}.aside"
    if store.exists(path):
        store.delete(aside)
        store.rename(path, aside)
    store.rename(new, path)
    store.delete(aside)
    spark.catalog.refreshByPath(path)


def standing(spark: SparkSession, path: str) -> str:
    """Where the dataset of this name is whole: under its name, or aside if a replacement was stopped before the last one stood."""
    path, store = path.rstrip("/"), Store(spark, path)
    return path if store.exists(path) or not store.exists(f"{path}.aside") else f"{path}.aside"


def publish(df: DataFrame, path: str) -> DataFrame:
    """Replace a Parquet folder by rows that may come from it: written beside it, then put in its place."""
    spark, new = df.sparkSession, f"{path.rstrip('/')}.next"
    df.write.mode("overwrite").parquet(new)
    put_in_place(spark, new, path)
    return spark.read.parquet(path)

"""Score statistics of fixed windows of a track that grows by files.

    python -m jobs.score_tracks --events PATH --output PATH --checkpoint PATH [--config FILE]

Each event is the score of one base: contig ``u<user_id>``, position ``event_id``. A run takes the files that came since the last
one, as the checkpoint of the file stream tells, and ends when none is left. A batch leaves the sums of its own records
under ``sums/batch=N`` and rewrites ``statistics`` for the buckets of contigs that it touched, from the sums of all batches.
Sums are whole numbers of hundredths, so neither the order nor the batches of records change a result. A batch that
failed on the way is repeated by the stream under the same number and overwrites what it left.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stranda.operators.signal import hundredths, statistics_of_sums

from .config import arguments, load

log = logging.getLogger("jobs.score_tracks")

EVENTS = "event_id long, user_id long, value double"
SUMS = "chrom string, window long, n_records long, s long, ss long, n_pos long, n_neg long, s_pos long, s_neg long, batch long, bucket int"
STATISTICS = "chrom string, start long, end long, n_records long, mean double, std double, frac_pos double, frac_neg double, mean_pos double, mean_neg double, bucket int"


def sums(events: DataFrame, config: dict) -> DataFrame:
    """Sums of hundredths for each window of a contig. Events without id, user or a finite value are no records."""
    value = F.col("value")
    good = events.filter("event_id is not null and user_id is not null and value is not null").filter(~F.isnan(value) & (F.abs(value) < 1e9))
    x = F.col("x")
    rows = good.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("chrom"), F.floor(F.col("event_id") / config["window"]).alias("window"),
        hundredths(value - F.lit(config["baseline"])).alias("x"),
    )
    grouped = rows.groupBy("chrom", "window").agg(
        F.count("*").alias("n_records"), F.sum(x).alias("s"), F.sum(x * x).alias("ss"), F.count_if(x > 0).alias("n_pos"), F.count_if(x < 0).alias("n_neg"),
        F.sum(F.greatest(x, F.lit(0))).alias("s_pos"), F.sum(F.least(x, F.lit(0))).alias("s_neg"),
    )
    return grouped.withColumn("bucket", F.pmod(F.xxhash64("chrom"), F.lit(config["buckets"])).cast("int"))


def statistics(parts: DataFrame, config: dict) -> DataFrame:
    """Statistics of windows from the sums of any number of batches; bases without a record count as 0."""
    whole = ("n_records", "s", "ss", "n_pos", "n_neg", "s_pos", "s_neg")
    total = parts.groupBy("bucket", "chrom", "window").agg(*(F.sum(c).alias(c) for c in whole))
    values = statistics_of_sums(F.lit(config["window"]), *map(F.col, whole[1:]))
    start = F.col("window") * config["window"]
    return total.select("chrom", start.alias("start"), (start + config["window"]).alias("end"), "n_records", *(v.alias(k) for k, v in values.items()), "bucket")


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def absorb(batch: DataFrame, number: int, output: str, config: dict) -> None:
    """One batch of new events: its sums, then the statistics of the buckets it touched."""
    spark = batch.sparkSession
    replace_partitions(sums(batch, config).withColumn("batch", F.lit(number).cast("long")), f"{output}/sums", "batch", "bucket")
    every = spark.read.schema(SUMS).parquet(f"{output}/sums")
    own = every.filter(F.col("batch") == number)
    touched = own.select("bucket").distinct()  # as many rows as there are buckets, at most
    replace_partitions(statistics(every.join(F.broadcast(touched), "bucket", "left_semi"), config), f"{output}/statistics", "bucket")
    n_records, n_windows = own.agg(F.coalesce(F.sum("n_records"), F.lit(0)), F.count("*")).head()
    log.info("batch %d: %d records of %d windows", number, n_records, n_windows)


def only(path: str) -> str:
    """A pattern that this path alone matches. A file stream over it takes a single file as well as a folder that grows."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def run(spark: SparkSession, events: str, output: str, checkpoint: str, config: dict) -> int:
    """Take what is new at ``events``; the number of batches that took."""
    # both folders stand from the first run on, with or without records
    for name, schema, by in (("sums", SUMS, ("batch", "bucket")), ("statistics", STATISTICS, ("bucket",))):
        spark.createDataFrame([], schema).write.mode("append").partitionBy(*by).parquet(f"{output}/{name}")
    new = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", config["files_per_batch"]).parquet(only(events))
    stream = (
        new.writeStream.foreachBatch(lambda batch, number: absorb(batch, number, output, config))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    stream.awaitTermination()
    taken = [p for p in stream.recentProgress if p.numInputRows]
    log.info("read %d new events in %d batches from %s", sum(p.numInputRows for p in taken), len(taken), events)
    return len(taken)


def read(spark: SparkSession, output: str) -> DataFrame:
    """The statistics as they stand."""
    return spark.read.schema(STATISTICS).parquet(f"{output}/statistics").drop("bucket")


def main() -> None:
    from stranda.session import session

    args = arguments(
        "Score statistics of windows of a growing track", events="Parquet files (event_id, user_id, value)", output="folder of sums and statistics",
        checkpoint="folder of the stream's checkpoint",
    )
    spark = session("score-tracks")
    try:
        run(spark, args.events, args.output, args.checkpoint, load(args.config, "score_tracks.toml"))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

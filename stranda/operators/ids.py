"""Dense ids in a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored


def dense_pair_id(rows: DataFrame, *order: str, name: str = "pair_id", ranges: int | None = None) -> DataFrame:
    """Ids 0, 1, 2, ... in the order of ``order``.

    Rows are dealt into ranges of the order, numbered within their range, and moved up by the sizes of the ranges
    before. The dealt rows are written once: ranges come from a sample, which another evaluation might draw
    otherwise. There are ``ranges`` of them, or as many as the session's shuffles have partitions.
    """
    dealt = stored((rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_part").count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # at most ``ranges`` rows
    bases = sizes.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn("_n", within).join(F.broadcast(bases), "_part").withColumn(
        name, (F.col("_base") + F.col("_n") - 1).cast("long")
    ).drop("_part", "_n", "_base")

"""Window cutting for regions that arrive as a stream.

Every step of ``context_windows`` is stateless (two joins with static tables and expressions), so it applies to a
streaming DataFrame as it is; ``window_stream`` writes what each trigger brings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import context_windows, dataset_rows


def window_stream(regions: DataFrame, tiles: DataFrame, path: str, checkpoint: str, policy: str = "causal", scope: str = "full") -> StreamingQuery:
    """Append dataset rows of a stream of regions (chrom, start, end, strand, name, category, pair_id) to a Parquet folder."""

    def cut(batch: DataFrame, _: int) -> None:
        rows = dataset_rows(context_windows(batch, tiles, policy), F.col("category"), F.lit(scope))
        rows.write.mode("append").parquet(path)

    return regions.writeStream.foreachBatch(cut).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

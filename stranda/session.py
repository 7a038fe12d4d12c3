"""Session defaults for interval work: adaptive execution, UTC, last value of duplicate map keys."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(app: str = "stranda", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def make_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever folder they start in.

    On a cluster where that folder is not shared the package is installed or sent along as usual.
    """
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])

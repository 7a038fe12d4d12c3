"""Stable sub-spans of a region by a keyed hash."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 100


def _exact_offsets(keys: pd.Series, choices: pd.Series) -> pd.Series:
    digests = (int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "little") for k in keys)
    return pd.Series([d % n if n > 0 else 0 for d, n in zip(digests, choices.astype("int64"), strict=True)], dtype="int64")


def stable_subspan(
    category: Column, pair_id: Column, start: Column, end: Column, seed: int = 42, exact: bool = True
) -> tuple[Column, Column]:
    """A span of 100 bases inside ``[start, end)`` that depends on the key alone; null in shorter regions.

    ``exact`` takes the offset of published outputs (an unsigned 64-bit BLAKE2b digest, which Spark lacks, in Arrow
    batches); otherwise a native 64-bit hash gives another offset of equal distribution inside whole-stage code.
    """
    key = F.concat_ws("|", F.lit(str(seed)), category, pair_id.cast("string"))
    choices = (end - start - (SPAN - 1)).cast("long")
    if exact:
        offset = F.pandas_udf(_exact_offsets, "long")(key, choices)
    else:
        offset = F.pmod(F.xxhash64(key), F.greatest(choices, F.lit(1).cast("long")))
    fits = choices > 0
    first = F.when(fits, start + offset).cast("int")
    return first, (first + SPAN).cast("int")

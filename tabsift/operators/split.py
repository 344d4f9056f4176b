"""Reproducible train/test split by key hash (M2).

``randomSplit`` depends on partitioning and row order (a repartition changes which rows land in train).
A bucket from the md5 of the key is a pure function of the key: same split on any cluster, any file
layout, on re-execution after a lost executor, and in plain SQL.  No shuffle, no sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsift.functions.exprs import hash_bucket, qcol

BUCKETS = 1000


def _cut(ratio: float) -> int:
    """Buckets in train; a ratio that is no multiple of 1 / BUCKETS is refused rather than rounded in silence."""
    cut = round(ratio * BUCKETS)
    if not 0 <= ratio <= 1 or abs(ratio * BUCKETS - cut) > 1e-6:
        raise ValueError(f"ratio {ratio} is not a multiple of 1/{BUCKETS} between 0 and 1")
    return cut


def assign_split(
    df: DataFrame,
    key: str,
    ratio: float = 0.8,
    seed: int = 42,
    split_col: str = "split",
    bucket_col: str | None = None,
) -> DataFrame:
    """Add ``split`` = ``train`` when bucket < ratio * 1000, else ``test``.  Rows sharing a key always
    fall on the same side."""
    bucket = hash_bucket(qcol(key), seed, BUCKETS)
    cut = _cut(ratio)
    out = df.withColumn(split_col, F.when(bucket < F.lit(cut), F.lit("train")).otherwise(F.lit("test")))
    if bucket_col:
        out = out.withColumn(bucket_col, bucket)
    return out


def split(df: DataFrame, key: str, ratio: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` as two filters of the same deterministic bucket (a null key goes to test,
    as in :func:`assign_split`, so no row is lost)."""
    in_train = F.coalesce(hash_bucket(qcol(key), seed, BUCKETS) < F.lit(_cut(ratio)), F.lit(False))
    return df.where(in_train), df.where(~in_train)

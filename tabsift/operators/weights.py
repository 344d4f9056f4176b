"""Balanced class weights (A4): ``w = N / (K * n_class)``.

The reference collected the counts and built a ``when`` chain.  Here the K-row weight table is a
DataFrame and is attached by a join: broadcast when its measured size is within
``max_broadcast_bytes`` (the count table is materialised first), else a shuffle join on the label, whose hot classes
AQE's skew-join handling splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsift.functions.exprs import qcol
from tabsift.operators.profile import label_counts

MAX_BROADCAST_BYTES = 8_000_000
ROW_BYTES = 64  # per row besides the label's own bytes


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``<label>, n, weight`` -- one row per class."""
    counts, total, k = label_counts(df, label)
    return _weights(counts, label, total, k)


def _weights(counts: DataFrame, label: str, total: int, k: int) -> DataFrame:
    denom = F.lit(max(k, 1)).cast("double") * F.col("n")
    return counts.select(label, "n", (F.lit(total).cast("double") / denom).alias("weight"))


def with_class_weight(
    df: DataFrame,
    label: str,
    weight_col: str = "class_weight",
    weights: DataFrame | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add ``weight_col`` to every row of ``df`` (rows are never dropped; a label missing from
    ``weights`` gets null).  ``weights`` defaults to :func:`class_weights` of ``df`` itself; pass the
    training set's table to weight other data the same way."""
    if weights is None:
        weights = class_weights(df, label)
    label_bytes = F.coalesce(F.octet_length(qcol(label).cast("string")), F.lit(0))
    size = weights.agg(F.coalesce(F.sum(label_bytes + ROW_BYTES), F.lit(0))).first()[0]
    table = weights.select(qcol(label).alias("__w_label"), F.col("weight").alias(weight_col))
    if size <= max_broadcast_bytes:
        table = F.broadcast(table)
    joined = df.join(table, qcol(label).eqNullSafe(F.col("__w_label")), "left")
    return joined.drop("__w_label")

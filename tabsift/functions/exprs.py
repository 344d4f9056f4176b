"""Column expressions shared by the operators.

All are compositions of ``pyspark.sql.functions`` so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")


def qcol(name: str) -> Column:
    """Column by exact name, safe for names holding dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_fractional(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_missing(c: Column, dtype: T.DataType) -> Column:
    """Null, or NaN for float/double columns (what an imputer treats as missing)."""
    if is_fractional(dtype):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_non_finite(c: Column, dtype: T.DataType) -> Column:
    """Null, NaN, +Inf or -Inf; for non-float types only null can occur."""
    if is_fractional(dtype):
        return c.isNull() | F.isnan(c) | c.isin(INF, -INF)
    return c.isNull()


def typed_lit(value, dtype: T.DataType) -> Column:
    """Literal cast to the column's own type, so filling an int column keeps it int."""
    return F.lit(value).cast(dtype)


def count_substring(text: Column, needle: str) -> Column:
    """Non-overlapping occurrences of ``needle`` in ``text`` over the whole text."""
    removed = F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))
    return (removed / F.lit(len(needle))).cast("bigint")


def hash_bucket(key: Column, seed: int = 42, buckets: int = 1000) -> Column:
    """Deterministic bucket in [0, buckets) from the md5 of ``key || ':' || seed``.

    Depends only on the key, never on partitioning or row order, so a split is reproducible on any
    cluster layout and in plain SQL: first 32 bits of the hex digest, as an unsigned number, mod buckets.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    first32 = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(first32, F.lit(buckets)).cast("int")

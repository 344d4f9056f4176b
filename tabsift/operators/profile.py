"""Profiling (P1-P11): every check over every column in one aggregate pass.

The reference ran one Spark action per column per check.  Here each profile is one ``agg`` whose
partial aggregation runs map-side; the one-row result is turned into one row per column with
``inline`` so the output is a long, joinable table.  A table too wide for one compiled ``agg`` is profiled by the
cells of its rows (:mod:`tabsift.operators.statistics`).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsift.functions.exprs import INF, is_fractional, is_non_finite, qcol
from tabsift.operators.statistics import StatisticsPlan
from tabsift.session import materialize
from tabsift.spec import DEFAULT_SENTINELS


def _fields(df: DataFrame, columns: Iterable[str] | None) -> list[T.StructField]:
    names = list(columns) if columns is not None else df.columns
    return [df.schema[n] for n in names]


#: Aggregates in one pass.  Beyond about 100 fields Spark gives up whole-stage code generation for an aggregate.
PASS_AGGREGATES = 48
#: Casts of text in one pass: the JVM leaves methods of over 8000 bytes of bytecode interpreted, and a cast takes some hundreds.
PASS_CASTS = 8


def long_form(df: DataFrame, parts: list[tuple[list[Column], Column]], empty_schema: str, per_pass: int = PASS_AGGREGATES) -> DataFrame:
    """One row per ``(aggregates, struct of them)`` in ``parts``; nothing to profile gives an empty table of
    ``empty_schema`` (no job).

    Wide tables take several passes, each over its own columns only (so a columnar source is still read once) and
    each narrow enough to be compiled."""
    if not parts:
        return df.sparkSession.createDataFrame([], empty_schema)
    passes: list[list[tuple[list[Column], Column]]] = [[]]
    for part in parts:
        if passes[-1] and sum(len(aggs) for aggs, _ in passes[-1]) + len(part[0]) > per_pass:
            passes.append([])
        passes[-1].append(part)
    frames = [df.agg(*(a for aggs, _ in own for a in aggs)).select(F.inline(F.array(*(row for _, row in own)))) for own in passes]
    return reduce(DataFrame.unionByName, frames)


def sentinel_match(c: Column, sentinels: Sequence[str], ignore_case: bool = False) -> Column:
    if ignore_case:
        return F.lower(c).isin([s.lower() for s in sentinels])
    return c.isin(list(sentinels))


def profile_shape(df: DataFrame) -> DataFrame:
    """``n_rows``, ``n_columns``."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def profile_columns(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    sentinels: Sequence[str] = DEFAULT_SENTINELS,
    ignore_case: bool = False,
) -> DataFrame:
    """Per column ``column, data_type, n_null, n_sentinel, n_nan, n_inf``.

    Sentinels are only looked for in string columns; NaN and Inf only in float/double columns
    (``isnan`` on other types is a type error, D7).
    """
    fields = _fields(df, columns)
    if sum(3 if is_fractional(f.dataType) else 2 if isinstance(f.dataType, T.StringType) else 1 for f in fields) > PASS_AGGREGATES:
        plan = StatisticsPlan(df, sentinels, ignore_case).want([f.name for f in fields], "null", "sentinel")
        plan.want([f.name for f in fields if is_fractional(f.dataType)], "nan", "inf")
        return plan.frame().select(
            "column",
            "data_type",
            *(F.col(s).alias(f"n_{s}") if s in plan.stats() else F.lit(0).cast("bigint").alias(f"n_{s}") for s in ("null", "sentinel", "nan", "inf")),
        )
    parts = []
    for i, f in enumerate(fields):
        aggs, c = [], qcol(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"null_{i}"))
        sent = nan = inf = F.lit(0)
        if isinstance(f.dataType, T.StringType):
            aggs.append(F.count_if(sentinel_match(c, sentinels, ignore_case)).alias(f"sent_{i}"))
            sent = F.col(f"sent_{i}")
        if is_fractional(f.dataType):
            aggs.append(F.count_if(F.isnan(c)).alias(f"nan_{i}"))
            aggs.append(F.count_if(c.isin(INF, -INF)).alias(f"inf_{i}"))
            nan, inf = F.col(f"nan_{i}"), F.col(f"inf_{i}")
        row = F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"null_{i}").cast("bigint").alias("n_null"),
            sent.cast("bigint").alias("n_sentinel"),
            nan.cast("bigint").alias("n_nan"),
            inf.cast("bigint").alias("n_inf"),
        )
        parts.append((aggs, row))
    return long_form(df, parts, "column string, data_type string, n_null bigint, n_sentinel bigint, "
                      "n_nan bigint, n_inf bigint")


def uncastable(c: Column, target: T.DataType) -> Column:
    """A present value that does not cast."""
    return c.isNotNull() & c.try_cast(target).isNull()


def _uncastable_text(c: Column, target: T.DataType) -> Column:
    """:func:`uncastable` of a text column.  Whether a usual sentinel casts is a constant, so it is not found out anew by a failing parse,
    which costs as much as several good ones."""
    bad = F.when(c.isNull(), F.lit(False))
    for s in DEFAULT_SENTINELS:
        bad = bad.when(c == F.lit(s), F.lit(s).try_cast(target).isNull())
    return bad.otherwise(c.try_cast(target).isNull())


def profile_uncastable(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per declared numeric column, how many present raw values fail ``try_cast``.

    Must run on the *pre-cast* text (after a cast the failures are already null, D3).
    Output ``column, target_type, n_uncastable``.
    """
    present = set(df.columns)
    targets = [f for f in schema.fields if f.name in present and isinstance(f.dataType, T.NumericType)]
    tests = [_uncastable_text if isinstance(df.schema[f.name].dataType, T.StringType) else uncastable for f in targets]
    aggs = [F.count_if(test(qcol(f.name), f.dataType)).alias(f"bad_{i}") for i, (test, f) in enumerate(zip(tests, targets))]
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("target_type"),
            F.col(f"bad_{i}").cast("bigint").alias("n_uncastable"),
        )
        for i, f in enumerate(targets)
    ]
    return long_form(df, [([a], r) for a, r in zip(aggs, rows)], "column string, target_type string, n_uncastable bigint", PASS_CASTS)


def sample_uncastable(df: DataFrame, column: str, target: T.DataType | str, n: int = 5) -> DataFrame:
    """P4 samples: the ``n`` most frequent raw values of ``column`` that do not cast, ``value, n``.

    Grouping is partially aggregated map-side (a hot bad value collapses per task) and the top-n is a
    ``TakeOrderedAndProject``; nothing but ``n`` rows reaches the driver.
    """
    if isinstance(target, str):
        target = T._parse_datatype_string(target)
    c = qcol(column)
    return (
        df.where(uncastable(c, target))
        .groupBy(c.alias("value"))
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
        .orderBy(F.col("n").desc(), F.col("value"))
        .limit(n)
    )


def label_counts(df: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """Per-class row counts, materialised once, with total rows ``N`` and class count ``K``.

    The count table is K rows; checkpointing it means the scan runs once although both the totals and
    the caller read it, and it reads from shared storage if an executor is lost.
    """
    counts = materialize(df.groupBy(qcol(label).alias(label)).agg(F.count(F.lit(1)).cast("bigint").alias("n")))
    total, k = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    return counts, int(total or 0), int(k or 0)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """``<label>, n, share`` with share = n / N."""
    counts, total, _ = label_counts(df, label)
    return counts.select(label, "n", (F.col("n") / F.lit(max(total, 1))).alias("share"))


def constant_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``column, stddev, is_constant`` -- constant means sample stddev 0 or null.

    ``is_constant`` is decided exactly, not from the floating-point stddev: Spark's merge of partial
    variance buffers can leave ~1e-12 on a column of one repeated value (the mean of a merge with an
    empty buffer is rebuilt as x/n*n).  Exact equivalent: at most one non-null value, or min == max
    with a finite value (any NaN or Inf makes the stddev NaN, which is not constant).
    """
    fields = [f for f in _fields(df, columns) if isinstance(f.dataType, T.NumericType)]
    if 4 * len(fields) > PASS_AGGREGATES:
        plan = StatisticsPlan(df).want([f.name for f in fields], "rows", "null", "min", "max", "stddev")
        lo, hi = F.col("min"), F.col("max")
        same = (lo == hi) & ~lo.isin("NaN", "Infinity", "-Infinity")  # equal values have equal texts
        return plan.frame().select("column", "stddev", (((F.col("rows") - F.col("null")) <= 1) | F.coalesce(same, F.lit(False))).alias("is_constant"))
    parts = []
    for i, f in enumerate(fields):
        c = qcol(f.name)
        aggs = [F.stddev_samp(c).alias(f"sd_{i}"), F.count(c).alias(f"n_{i}"),
                 F.min(c).alias(f"lo_{i}"), F.max(c).alias(f"hi_{i}")]
        lo, hi = F.col(f"lo_{i}"), F.col(f"hi_{i}")
        same = lo == hi
        if is_fractional(f.dataType):
            same = same & ~F.isnan(lo) & ~lo.isin(INF, -INF)
        row = F.struct(
            F.lit(f.name).alias("column"),
            F.col(f"sd_{i}").alias("stddev"),
            ((F.col(f"n_{i}") <= 1) | same).alias("is_constant"),
        )
        parts.append((aggs, row))
    return long_form(df, parts, "column string, stddev double, is_constant boolean")


def constant_column_names(df: DataFrame, columns: Iterable[str] | None = None) -> list[str]:
    """Names of the constant columns (one job; at most one row per column reaches the driver)."""
    cols = None if columns is None else list(columns)
    if cols == []:
        return []
    return [r["column"] for r in constant_columns(df, cols).where("is_constant").collect()]


def split_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split value, ``split, n``."""
    return df.groupBy(qcol(split_col).alias("split")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def _row_has_non_finite(df: DataFrame, columns: Sequence[str] | str) -> Column:
    from pyspark.ml.functions import vector_to_array

    if isinstance(columns, str):
        dtype = df.schema[columns].dataType
        if isinstance(dtype, T.ArrayType):
            arr = qcol(columns)
        else:  # ML vector
            arr = vector_to_array(qcol(columns))
        return qcol(columns).isNull() | F.exists(arr, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(INF)))
    cond = F.lit(False)
    for name in columns:
        cond = cond | is_non_finite(qcol(name), df.schema[name].dataType)
    return cond


def count_non_finite_rows(df: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """``n_rows, n_non_finite`` where a row counts if any of ``columns`` (or any slot of a
    vector/array column) is null, NaN or infinite.  Native ``exists``; no Python UDF."""
    bad = _row_has_non_finite(df, columns)
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_if(bad).cast("bigint").alias("n_non_finite"),
    )


def sample_rows(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """P10: ``n`` rows, ordered by ``order_by`` (a key) so the sample is deterministic."""
    if order_by:
        return df.orderBy(*[qcol(c) for c in order_by]).limit(n)
    return df.limit(n)


def profile_schema(df: DataFrame) -> DataFrame:
    """``position, column, data_type, nullable`` from the schema (no job runs)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, data_type string, nullable boolean"
    )

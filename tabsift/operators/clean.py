"""Cleaning (C1-C18).  Each step is one ``select`` over all columns, never a chain of ``withColumn``.

Literals are typed to the target column (an int column filled with 0 stays int, D24) and every cast is
``try_cast`` (Spark 4 ANSI casts raise on bad text, D22).
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsift.functions.exprs import is_missing, is_non_finite, qcol, typed_lit
from tabsift.operators.profile import constant_column_names, sentinel_match
from tabsift.operators.statistics import PICK_LIMIT, StatisticsPlan
from tabsift.session import materialize
from tabsift.spec import DEFAULT_SENTINELS


def _replace(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Replace some columns in place, keeping column order, in a single projection."""
    return df.select(*[exprs[c].alias(c) if c in exprs else qcol(c) for c in df.columns])


def _check_present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    cols = list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return cols


# ---------------------------------------------------------------- names and schema


def normalized_names(columns: Sequence[str]) -> list[str]:
    """``.`` -> ``_``; raises if two names collide (also case-insensitively, as Spark resolves)."""
    out = [c.replace(".", "_") for c in columns]
    seen: dict[str, str] = {}
    for old, new in zip(columns, out):
        key = new.lower()
        if key in seen:
            raise ValueError(f"normalised name collision: {seen[key]!r} and {old!r} both become {new!r}")
        seen[key] = old
    return out


def normalize_names(df: DataFrame) -> DataFrame:
    """Rename columns so none holds a dot (``col("a.b")`` would otherwise not resolve)."""
    return df.toDF(*normalized_names(df.columns))


def check_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """C4: compare by name and type: ``column, problem, expected, actual`` (no rows = matches)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    rows = []
    for name, dtype in want.items():
        if name not in have:
            rows.append((name, "missing", dtype.simpleString(), None))
        elif have[name] != dtype:
            rows.append((name, "type", dtype.simpleString(), have[name].simpleString()))
    for name, dtype in have.items():
        if name not in want:
            rows.append((name, "extra", None, dtype.simpleString()))
    return df.sparkSession.createDataFrame(rows, "column string, problem string, expected string, actual string")


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop by name; unknown names are ignored."""
    return df.drop(*list(cols))


def feature_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """Every column not excluded, in schema order."""
    skip = set(exclude)
    return [c for c in df.columns if c not in skip]


# ---------------------------------------------------------------- text normalisation


def lowercase(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Lower-case the named string columns; null stays null."""
    return _replace(df, {c: F.lower(qcol(c)) for c in _check_present(df, cols)})


def replace_sentinels(
    df: DataFrame,
    cols: Iterable[str] | None = None,
    sentinels: Sequence[str] = DEFAULT_SENTINELS,
    value: str | None = "0",
    ignore_case: bool = False,
) -> DataFrame:
    """Sentinel texts -> ``value`` (``None`` turns them into null).  Only string columns."""
    names = list(cols) if cols is not None else df.columns
    exprs = {}
    for c in names:
        if isinstance(df.schema[c].dataType, T.StringType):
            exprs[c] = F.when(sentinel_match(qcol(c), sentinels, ignore_case), F.lit(value).cast("string")).otherwise(qcol(c))
    return _replace(df, exprs)


# ---------------------------------------------------------------- casting


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``try_cast`` every listed column to its declared type; other columns are kept."""
    exprs = {f.name: qcol(f.name).try_cast(f.dataType) for f in schema.fields if f.name in df.columns}
    return _replace(df, exprs)


def cast_columns(df: DataFrame, cols: Iterable[str], dtype: T.DataType | str = "double") -> DataFrame:
    """``try_cast`` the named columns to one type (bad text -> null)."""
    return _replace(df, {c: qcol(c).try_cast(dtype) for c in _check_present(df, cols)})


# ---------------------------------------------------------------- fills


def fill_constant(df: DataFrame, cols: Iterable[str], value=0) -> DataFrame:
    """Null -> ``value`` typed to each column."""
    cols = _check_present(df, cols)
    return _replace(df, {c: F.coalesce(qcol(c), typed_lit(value, df.schema[c].dataType)) for c in cols})


def replace_non_finite(df: DataFrame, cols: Iterable[str], value=0.0) -> DataFrame:
    """C11: null, NaN, +Inf, -Inf -> ``value`` typed to each column."""
    exprs = {}
    for c in _check_present(df, cols):
        dtype = df.schema[c].dataType
        exprs[c] = F.when(is_non_finite(qcol(c), dtype), typed_lit(value, dtype)).otherwise(qcol(c))
    return _replace(df, exprs)


def fill_category(df: DataFrame, cols: Iterable[str], value: str = "unknown") -> DataFrame:
    """Null category -> ``value``; columns that are not strings hold no categories and stay as they are."""
    strings = [c for c in _check_present(df, cols) if isinstance(df.schema[c].dataType, T.StringType)]
    return _replace(df, {c: F.coalesce(qcol(c), F.lit(value)) for c in strings})


def medians(
    df: DataFrame, cols: Sequence[str], exact: bool = True, relative_error: float = 0.001, pick_limit: int = PICK_LIMIT
) -> dict[str, object]:
    """Median of each column over its non-missing values (null/NaN ignored); None if none.

    ``exact=True``: the lower median (``percentile_disc(0.5)``), see :mod:`tabsift.operators.statistics`.
    ``exact=False``: ``percentile_approx`` for all columns in one pass (rank error <= relative_error).
    """
    cols = list(cols)
    if not cols:
        return {}
    if not exact:
        accuracy = max(1, int(round(1.0 / relative_error)))
        aggs = []
        for i, c in enumerate(cols):
            dtype = df.schema[c].dataType
            v = F.when(~is_missing(qcol(c), dtype), qcol(c))
            aggs.append(F.percentile_approx(v, 0.5, accuracy).alias(f"m_{i}"))
        row = df.agg(*aggs).first()
        return {c: row[f"m_{i}"] for i, c in enumerate(cols)}
    stats = StatisticsPlan(df, pick_limit=pick_limit).want(cols, "median").collect()
    return {c: stats[c]["median"] for c in cols}


def impute(
    df: DataFrame,
    cols: Iterable[str],
    strategy: str = "median",
    exact: bool = True,
    fallback=0,
    relative_error: float = 0.001,
) -> DataFrame:
    """C9 (+C10 fallback): replace null (and NaN in float columns) by the column's median or mean.

    The statistic is typed back to the column (int stays int).  A column with no present value gets
    ``fallback`` instead of failing the whole step (D4).
    """
    cols = [c for c in _check_present(df, cols) if isinstance(df.schema[c].dataType, T.NumericType)]
    if strategy == "median":
        stats = medians(df, cols, exact=exact, relative_error=relative_error)
    elif strategy == "mean":
        aggs = [F.avg(F.when(~is_missing(qcol(c), df.schema[c].dataType), qcol(c))).alias(f"m_{i}")
                for i, c in enumerate(cols)]
        row = df.agg(*aggs).first() if aggs else None
        stats = {c: row[f"m_{i}"] for i, c in enumerate(cols)} if row else {}
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    exprs = {}
    for c in cols:
        dtype = df.schema[c].dataType
        value = stats.get(c)
        if value is None:
            warnings.warn(f"{c}: no present value to impute from; filling {fallback!r}")
            value = fallback
        exprs[c] = F.when(is_missing(qcol(c), dtype), typed_lit(value, dtype)).otherwise(qcol(c))
    return _replace(df, exprs)


# ---------------------------------------------------------------- constants, duplicates, ranges


def zero_where_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Named columns become 0 (typed) where not null; null stays null."""
    exprs = {c: F.when(qcol(c).isNotNull(), typed_lit(0, df.schema[c].dataType)) for c in _check_present(df, cols)}
    return _replace(df, exprs)


def neutralize_constant(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Constant numeric columns (P7) become 0 where not null."""
    return zero_where_present(df, constant_column_names(df, cols))


def drop_constant(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """C14: drop the constant numeric columns."""
    return df.drop(*constant_column_names(df, cols))


#: Digests of repeated rows are broadcast up to this size.
REPEATED_BYTES = 64_000_000
DIGEST_BYTES = 32


def deduplicate(
    df: DataFrame, subset: Sequence[str] | None = None, by: str = "rows", max_broadcast_bytes: int = REPEATED_BYTES, write_moved: bool = False
) -> DataFrame:
    """Whole-row (or subset) de-duplication.

    ``by="rows"``: planned as a hash aggregate with a map-side partial step, so many copies of one row collapse
    before the shuffle.  Run it before encoding: same result, narrower rows.

    ``by="digest"`` (whole rows): first only 128-bit digests are counted; then rows whose digest is held once stay where they are, and
    only rows whose digest repeats are moved and compared in full.  The repeated digests are broadcast if they measure
    ``max_broadcast_bytes`` at most; a table with more distinct repeated rows is de-duplicated by rows, as is one with nested columns.
    ``df`` is read twice, so it should be a written table or one whose rows are worked out alike each time.  ``write_moved`` writes what is left of the moved rows to the shared
    checkpoint folder, for a result that is read several times.
    """
    moved = materialize if write_moved else (lambda rows: rows)
    if by == "rows" or subset:
        return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()
    if by != "digest":
        raise ValueError(f"unknown by {by!r}")
    if any(isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) for f in df.schema.fields):
        return moved(df.dropDuplicates())
    cols = []
    for f in df.schema.fields:  # equal rows have equal digests: -0.0 equals 0.0
        cols.append(qcol(f.name) + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else qcol(f.name))
    nulls = [qcol(c).isNull() for c in df.columns]
    digest = [F.xxhash64(*cols, *nulls).alias("__d1"), F.xxhash64(F.lit("2"), *nulls, *cols).alias("__d2")]
    counted = df.select(*digest).groupBy("__d1", "__d2").agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(counted.where(F.col("n") > 1).select("__d1", "__d2", F.lit(True).alias("__again")))
    n_repeated = repeated.count()
    if not n_repeated:
        return df
    if n_repeated * DIGEST_BYTES > max_broadcast_bytes:
        return moved(df.dropDuplicates())
    marked = df.select(*map(qcol, df.columns), *digest).join(F.broadcast(repeated), ["__d1", "__d2"], "left")
    again = F.col("__again").isNotNull()
    keep = [qcol(c) for c in df.columns]
    return marked.where(~again).select(*keep).unionByName(moved(marked.where(again).select(*keep).dropDuplicates()))


def clamp_min(df: DataFrame, cols: Iterable[str], minimum=0) -> DataFrame:
    """Values below ``minimum`` -> ``minimum`` (typed); null and NaN pass unchanged."""
    exprs = {}
    for c in _check_present(df, cols):
        lo = typed_lit(minimum, df.schema[c].dataType)
        exprs[c] = F.when(qcol(c) < lo, lo).otherwise(qcol(c))
    return _replace(df, exprs)


def drop_non_finite_rows(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Drop rows where any named column (or any slot of a vector/array column) is null, NaN or
    infinite.  Native ``exists`` over the array, no Python UDF."""
    from tabsift.operators.profile import _row_has_non_finite

    return df.where(~_row_has_non_finite(df, cols))


__all__ = [
    "cast_columns",
    "cast_to_schema",
    "check_schema",
    "clamp_min",
    "deduplicate",
    "drop_columns",
    "drop_constant",
    "drop_non_finite_rows",
    "feature_columns",
    "fill_category",
    "fill_constant",
    "impute",
    "lowercase",
    "medians",
    "neutralize_constant",
    "normalize_names",
    "normalized_names",
    "replace_non_finite",
    "replace_sentinels",
    "zero_where_present",
]

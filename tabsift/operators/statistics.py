"""Column statistics in shared passes.

Operators say which statistics of which columns they need; :class:`StatisticsPlan` drops what is asked for twice and takes the rest
in one job.  A row becomes one cell per column (``posexplode`` of an array), cells are aggregated by column number with a
map-side partial, and the generated code stays as small for 84 columns as for one.  Columns that fit one type share a
pass: types that a double holds exactly go together, other numeric types and text each have their own.

Exact medians are part of the plan.  A KLL sketch taken in the same pass gives a bracket around the middle rank; a second job
counts what lies below the bracket and the distinct values in it, which verifies the bracket and picks the value.  A bracket that is
still too full is narrowed by a sketch of its inside; a bracket that misses is replaced by the part that must hold the rank.
So the value is always exact and only the number of passes varies.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsift.functions.exprs import INF, qcol
from tabsift.spec import DEFAULT_SENTINELS

#: Size of a stored quantile sketch; its rank error is about 2.3 / K ** 0.9 of the rows (99 %).
SKETCH_K = 1000
#: Size of the sketch that brackets an exact median: the bracket holds about half a percent of the rows.
BRACKET_K = 4000
#: Quantiles read from a sketch: multiples of 1 / GRID.
GRID = 512
#: At most about this many values of a column go to the last pass of a median, where one task sorts them; more cost a pass over the table.
PICK_LIMIT = 1_000_000
#: Columns of one pass (Spark's object hash aggregate sorts beyond 128 groups).
PASS_COLUMNS = 100

COUNTS = ("rows", "null", "present", "sentinel", "nan", "inf")
VALUES = ("min", "max", "low", "high")
_DOUBLE_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)


def rank_error(k: int) -> float:
    return 2.296 / k**0.9021


def _family(dtype: T.DataType) -> T.DataType:
    """The type whose pass a column joins; of types that are neither numbers nor text only presence is looked at."""
    if isinstance(dtype, _DOUBLE_EXACT):
        return T.DoubleType()
    if isinstance(dtype, (T.NumericType, T.StringType)):
        return dtype
    return T.BooleanType()


def cells(df: DataFrame, columns: Sequence[str], family: T.DataType) -> DataFrame:
    """``cid, v``: one row per row and column, ``cid`` the column's place in ``columns``."""
    if isinstance(family, T.BooleanType):
        values = [F.when(qcol(c).isNotNull(), F.lit(True)) for c in columns]
    else:
        values = [qcol(c).cast(family) for c in columns]
    return df.select(F.posexplode(F.array(*values)).alias("cid", "v"))


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A small table of constants that no job has to ship."""
    fields = T._parse_datatype_string(schema).fields
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def parse_value(text: str | None, dtype: T.DataType):
    """A value of the column's type from its text."""
    if text is None:
        return None
    if isinstance(dtype, T.IntegralType):
        return int(Decimal(text))
    return Decimal(text) if isinstance(dtype, T.DecimalType) else float(text)


class StatisticsPlan:
    """``want`` statistics, then ``frame`` (lazy, one row per column) or ``collect`` (with medians) them.

    Counts: ``rows``, ``null``, ``present`` (neither null nor NaN), ``sentinel`` (text only), ``nan`` and ``inf`` (floating point only).
    Values: ``min`` and ``max`` (NaN above all), ``low`` and ``high`` (of finite values), ``stddev``, ``median`` (lower median of present values).
    """

    def __init__(
        self,
        df: DataFrame,
        sentinels: Sequence[str] = DEFAULT_SENTINELS,
        ignore_case: bool = False,
        sketch_k: int = BRACKET_K,
        pick_limit: int = PICK_LIMIT,
    ):
        self.df, self.sentinels, self.ignore_case = df, sentinels, ignore_case
        self.sketch_k, self.pick_limit = sketch_k, pick_limit
        self.wanted: dict[str, set[str]] = {}
        self.types = {f.name: f.dataType for f in df.schema.fields}

    def want(self, columns: Iterable[str], *stats: str) -> StatisticsPlan:
        for c in columns:
            self.wanted.setdefault(c, set()).update(stats)
        return self

    def stats(self) -> list[str]:
        return [s for s in (*COUNTS, *VALUES, "stddev") if any(s in own for own in self.wanted.values())]

    def _passes(self, columns: Iterable[str]) -> list[tuple[T.DataType, list[str]]]:
        by_family: dict[str, tuple[T.DataType, list[str]]] = {}
        for c in columns:
            family = _family(self.types[c])
            by_family.setdefault(family.simpleString(), (family, []))[1].append(c)
        return [(family, own[i : i + PASS_COLUMNS]) for family, own in by_family.values() for i in range(0, len(own), PASS_COLUMNS)]

    def _aggregate(self, family: T.DataType, stat: str) -> Column | None:
        v, floating, number = F.col("v"), isinstance(family, T.DoubleType), isinstance(family, T.NumericType)
        finite = F.when(~F.isnan(v) & ~v.isin(INF, -INF), v) if floating else v
        if stat == "rows":
            return F.count(F.lit(1))
        if stat == "null":
            return F.count_if(v.isNull())
        if stat == "present":
            return F.count_if(_present(family))
        if stat == "sentinel" and isinstance(family, T.StringType):
            low = [s.lower() for s in self.sentinels]
            return F.count_if(F.lower(v).isin(low) if self.ignore_case else v.isin(list(self.sentinels)))
        if stat == "nan" and floating:
            return F.count_if(F.isnan(v))
        if stat == "inf" and floating:
            return F.count_if(v.isin(INF, -INF))
        if not number:
            return None
        return {"min": F.min(v), "max": F.max(v), "low": F.min(finite), "high": F.max(finite), "stddev": F.stddev_samp(v.cast("double"))}.get(stat)

    def _pass(self, family: T.DataType, columns: list[str], stats: list[str], sketch: bool) -> DataFrame:
        asked = [s for s in stats if any(s in self.wanted[c] for c in columns)]
        aggs = {s: a for s in asked if (a := self._aggregate(family, s)) is not None}
        aggs = aggs or {"rows": F.count(F.lit(1))}
        quantiles = F.lit(None).cast("array<double>")
        extra = []
        if sketch and isinstance(family, T.NumericType) and any("median" in self.wanted[c] for c in columns):
            margin = min(0.5, 2 * rank_error(self.sketch_k))
            middle = [0.5 - margin, 0.5 + margin]
            sketch_of = F.when(_present(family), F.col("v").cast("double"))
            extra = [F.kll_sketch_agg_double(sketch_of, self.sketch_k).alias("sketch"), F.count_if(_present(family)).alias("n_sketch")]
            quantiles = F.when(F.col("n_sketch") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, middle))))
        grouped = cells(self.df, columns, family).groupBy("cid").agg(*(a.alias(s) for s, a in aggs.items()), *extra)
        name = F.element_at(F.array(*(F.lit(c) for c in columns)), F.col("cid") + 1)
        kind = {s: "bigint" if s in COUNTS else "double" if s == "stddev" else "string" for s in stats}
        out = [(F.col(s) if s in aggs else F.lit(0 if s in COUNTS else None)).cast(kind[s]).alias(s) for s in stats]
        return grouped.select(name.alias("column"), *out, *([quantiles.alias("quantiles")] if sketch else []))

    def _frame(self, sketch: bool) -> DataFrame:
        frames = [self._pass(family, own, self.stats(), sketch) for family, own in self._passes(self.wanted)]
        return reduce(DataFrame.unionByName, frames)

    def frame(self) -> DataFrame:
        """``column, data_type`` and a column per wanted statistic but medians: counts as bigint, ``stddev`` as double, other values as
        text.  A table without rows has counts of 0."""
        rows = [(c, self.types[c].simpleString()) for c in self.wanted]
        names = literal_rows(self.df.sparkSession, rows, "column string, data_type string")
        if not self.wanted:
            return names
        found = self._frame(sketch=False)
        joined = names.join(F.broadcast(found), "column", "left")  # one row per column on both sides
        return joined.select("column", "data_type", *(F.coalesce(F.col(s), F.lit(0)).alias(s) if s in COUNTS else F.col(s) for s in found.columns[1:]))

    def collect(self) -> dict[str, dict[str, object]]:
        """Statistics by column, values in the column's type; one row per column comes to the driver."""
        medians = [c for c, own in self.wanted.items() if "median" in own]
        for c in medians:
            self.wanted[c].add("present")
        out = {c: {s: 0 if s in COUNTS else None for s in own} for c, own in self.wanted.items()}
        if not self.wanted:
            return out
        brackets: dict[str, list[float]] = {}
        for row in self._frame(sketch=bool(medians)).collect():
            c = row["column"]
            for s in self.wanted[c] & set(row.asDict()):
                out[c][s] = parse_value(row[s], self.types[c]) if s in VALUES else row[s]
            if medians and row["quantiles"] is not None:
                brackets[c] = row["quantiles"]
        todo = {c: _Bracket(out[c]["present"], *brackets[c], 2 * rank_error(self.sketch_k)) for c in medians if out[c]["present"]}
        for c, value in select_ranks(self, todo).items():
            out[c]["median"] = value
        return out


def _present(family: T.DataType, v: Column | None = None) -> Column:
    v = F.col("v") if v is None else v
    return v.isNotNull() & ~F.isnan(v) if isinstance(family, T.DoubleType) else v.isNotNull()


class _Bracket:
    """Where the value of a rank lies: between ``low`` and ``high``, ends included, if the sketch was right; surely in ``outer``."""

    def __init__(self, n: int, low: float, high: float, margin: float):
        self.rank = math.ceil(n / 2)
        self.low, self.high, self.outer = low, high, (None, None)
        self.inside = min(1.0, 2 * margin) * n

    def miss(self, above: bool) -> None:
        self.low, self.high = (self.high, self.outer[1]) if above else (self.outer[0], self.low)
        self.outer, self.inside = (self.low, self.high), math.inf


def _of_column(values: Sequence, dtype: str = "double") -> Column:
    """The constant of the cell's column."""
    return F.element_at(F.array(*(F.lit(v).cast(dtype) for v in values)), F.col("cid") + 1)


def select_ranks(plan: StatisticsPlan, todo: dict[str, _Bracket]) -> dict[str, object]:
    """The exact value at each bracket's rank."""
    found: dict[str, object] = {}
    while len(found) < len(todo):
        full = [c for c, b in todo.items() if c not in found and b.inside > plan.pick_limit]
        if full:
            _narrow(plan, {c: todo[c] for c in full})
        ready = [c for c, b in todo.items() if c not in found and b.inside <= plan.pick_limit]
        if ready:
            found.update(_pick(plan, {c: todo[c] for c in ready}))
    return found


def _narrow(plan: StatisticsPlan, todo: dict[str, _Bracket]) -> None:
    """One pass that counts below, at the ends of and inside each bracket and sketches the inside."""
    frames = []
    for family, columns in plan._passes(todo):
        key = F.col("v").cast("double")
        low, high = (_of_column([getattr(todo[c], end) for c in columns]) for end in ("low", "high"))
        above_low, below_high = low.isNull() | (key > low), high.isNull() | (key < high)
        inner = above_low & below_high
        grouped = cells(plan.df, columns, family).where(_present(family)).groupBy("cid").agg(
            F.count_if(key < low).alias("below"),
            F.count_if(key == low).alias("at_low"),
            F.count_if(inner).alias("inner"),
            F.count_if((key == high) & above_low).alias("at_high"),
            F.kll_sketch_agg_double(F.when(inner, key), plan.sketch_k).alias("sketch"),
        )
        grid = F.array(*(F.lit(i / GRID) for i in range(GRID + 1)))
        name = F.element_at(F.array(*(F.lit(c) for c in columns)), F.col("cid") + 1)
        quantiles = F.when(F.col("inner") > 0, F.kll_sketch_get_quantile_double("sketch", grid))
        frames.append(grouped.select(name.alias("column"), "below", "at_low", "inner", "at_high", quantiles.alias("quantiles")))
    for row in reduce(DataFrame.unionByName, frames).collect():
        b = todo[row["column"]]
        to_inner = row["below"] + row["at_low"]
        if b.rank <= row["below"]:
            b.miss(above=False)
        elif b.rank <= to_inner:
            b.high, b.inside = b.low, 0
        elif b.rank <= to_inner + row["inner"]:
            share, error = (b.rank - to_inner) / row["inner"], 2 * rank_error(plan.sketch_k)
            first, last = math.floor((share - error) * GRID), math.ceil((share + error) * GRID)
            b.outer = (b.low, b.high)
            b.low = row["quantiles"][first] if first > 0 else b.low
            b.high = row["quantiles"][last] if last < GRID else b.high
            b.inside = min(1.0, (last - first) / GRID + 2 * error) * row["inner"]
            if (b.low, b.high) == b.outer:  # too coarse a sketch to part the inside: all of it goes to the last pass
                b.inside = 0
        elif b.rank <= to_inner + row["inner"] + row["at_high"]:
            b.low, b.inside = b.high, 0
        else:
            b.miss(above=True)


def _pick(plan: StatisticsPlan, todo: dict[str, _Bracket]) -> dict[str, object]:
    """Distinct values inside each bracket with their counts, on top of what lies below: the value at the rank, unless the bracket
    misses it."""
    frames = []
    for family, columns in plan._passes(todo):
        key = F.col("v").cast("double")
        low, high = (_of_column([getattr(todo[c], end) for c in columns]) for end in ("low", "high"))
        kept = cells(plan.df, columns, family).where(_present(family) & (high.isNull() | (key <= high)))
        kept = kept.select("cid", F.when(low.isNull() | (key >= low), F.col("v")).alias("v"))  # null: below
        counted = kept.groupBy("cid", "v").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("cid").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
        rank = _of_column([todo[c].rank for c in columns], "bigint")
        hit = counted.withColumn("upto", upto).where((F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank))
        name = F.element_at(F.array(*(F.lit(c) for c in columns)), F.col("cid") + 1)
        frames.append(hit.select(name.alias("column"), F.col("v").cast("string").alias("v")))
    hits = {row["column"]: row["v"] for row in reduce(DataFrame.unionByName, frames).collect()}
    out = {}
    for c, b in todo.items():
        if hits.get(c) is not None:
            out[c] = parse_value(hits[c], plan.types[c])
        else:
            b.miss(above=c not in hits)
    return out


def constant_after_fill(stats: dict[str, object], fill) -> bool:
    """Whether a numeric column holds one value once missing values are ``fill`` and infinities 0 (statistics: rows, null, nan, inf,
    low, high)."""
    values = {v for v in (stats["low"], stats["high"]) if v is not None}
    if stats["null"] or stats.get("nan"):
        values.add(0 if isinstance(fill, float) and not math.isfinite(fill) else fill)
    if stats.get("inf"):
        values.add(0)
    return stats["rows"] <= 1 or len(values) <= 1


__all__ = ["StatisticsPlan", "cells", "constant_after_fill", "literal_rows", "parse_value", "rank_error", "select_ranks"]

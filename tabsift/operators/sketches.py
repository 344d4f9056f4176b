"""Quantile sketches as stored state (C9, approximate, at scale).

A state is a table ``part, column, n, sketch`` with one KLL sketch per part of the data (a day, a file, a load) and column.  States
are written, appended to as parts arrive, and merged when quantiles are asked for, so data already sketched is not read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsift.operators.statistics import PASS_COLUMNS, SKETCH_K, cells, rank_error


def quantile_state(df: DataFrame, columns: Sequence[str], part: Column | None = None, k: int = SKETCH_K) -> DataFrame:
    """``part, column, n, sketch`` of the present (neither null nor NaN) values of numeric columns, as doubles.

    Cells are sketched where they lie and the sketches of a part merged, so no values are moved.  A part without a present value has
    no row for the column."""
    columns, frames = list(columns), []
    number = T.DoubleType()
    for i in range(0, len(columns), PASS_COLUMNS):
        own = columns[i : i + PASS_COLUMNS]
        tagged = df.withColumn("__part", (part if part is not None else F.lit("all")).cast("string"))
        values = F.posexplode(F.array(*(tagged[f"`{c}`"].cast(number) for c in own)))
        long = tagged.select(F.col("__part").alias("part"), values.alias("cid", "v")).where(~F.isnan("v") & F.col("v").isNotNull())
        made = long.groupBy("part", "cid").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("v", k).alias("sketch"))
        name = F.element_at(F.array(*map(F.lit, own)), F.col("cid") + 1)
        frames.append(made.select("part", name.alias("column"), "n", "sketch"))
    return reduce(DataFrame.unionByName, frames)


def merge_states(state: DataFrame) -> DataFrame:
    """``column, n, sketch``: the sketches of all parts as one."""
    return state.groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def state_quantiles(state: DataFrame, q: float = 0.5, k: int = SKETCH_K) -> DataFrame:
    """``column, n, value, bound``: the quantile and how far its rank may be off, as a part of ``n`` (99 %)."""
    merged = merge_states(state)
    return merged.select("column", "n", F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("value"), F.lit(rank_error(k)).alias("bound"))


def rank_of(df: DataFrame, quantiles: DataFrame) -> DataFrame:
    """``column, n, value, bound, below, upto``: how many present values of ``df`` lie below each value and up to it, in one pass."""
    rows = quantiles.collect()  # one per column
    frames = []
    for i in range(0, len(rows), PASS_COLUMNS):
        own = rows[i : i + PASS_COLUMNS]
        of = lambda field: F.element_at(F.array(*(F.lit(r[field]) for r in own)), F.col("cid") + 1)  # noqa: E731, B023
        long = cells(df, [r["column"] for r in own], T.DoubleType()).where(~F.isnan("v") & F.col("v").isNotNull())
        counted = long.groupBy("cid").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < of("value")).alias("below"), F.count_if(F.col("v") <= of("value")).alias("upto")
        )
        frames.append(counted.select(of("column").alias("column"), "n", of("value").alias("value"), of("bound").alias("bound"), "below", "upto"))
    return reduce(DataFrame.unionByName, frames)

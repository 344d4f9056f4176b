"""Delimited text in and out.

Paths go straight to Spark (``hdfs://``, ``s3a://``, ``file:`` or plain), never rebuilt into URIs
(D13).  Parquet is the preferred input at scale (columnar, pushdown); delimited text is supported for
the reference's TSV files.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsift.functions.exprs import qcol
from tabsift.operators.profile import long_form


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = "\t",
    header: bool = True,
    infer: bool = True,
    schema: T.StructType | str | None = None,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """Header + delimiter scan.

    ``schema`` given: no inference pass.  ``infer=True``: one extra pass (optionally over a
    ``sampling_ratio`` of rows) to pick types.  ``infer=False``: every column is a string.
    If the delimiter yields at most one column the file is not what was assumed; the raw lines are
    returned as a single ``value`` column (S3) with a warning.
    """
    reader = spark.read.option("sep", sep).option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
        if sampling_ratio:
            reader = reader.option("samplingRatio", str(sampling_ratio))
    df = reader.csv(path)
    if len(df.columns) <= 1 and schema is None:
        warnings.warn(f"{path}: delimiter {sep!r} gives {len(df.columns)} column(s); returning raw lines")
        return spark.read.text(path)
    return df


class Scan(NamedTuple):
    """Rows that fit the schema, and ``line, file`` of those that do not."""

    rows: DataFrame
    rejects: DataFrame


CORRUPT = "__tabsift_corrupt"


def scan_delimited(
    spark: SparkSession, path: str, sep: str = "\t", infer: bool = False, schema: T.StructType | str | None = None, header: bool = True
) -> Scan:
    """S1/S2 that lets no malformed row pass unseen: rows with too few or too many fields, or with a value that is not of its type,
    are kept whole in a table of their own.

    Without ``schema`` the columns are the header's, as text or (``infer``) with inferred types.  Both tables are lazy scans of
    the same files."""
    if schema is None:
        schema = read_delimited(spark, path, sep, header, infer).schema
    elif isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
    reader = reader.option("sep", sep).option("header", str(header).lower()).option("mode", "PERMISSIVE")
    lines = reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    bad = qcol(CORRUPT).isNotNull()
    parsed = F.pmod(F.xxhash64(*map(qcol, schema.names)), F.lit(2)) >= 0  # always true; a row is only judged if its fields are read
    rejects = lines.where(bad & parsed).select(qcol(CORRUPT).alias("line"), F.col("_metadata.file_path").alias("file"))
    return Scan(lines.where(~bad & parsed).drop(CORRUPT), rejects)


def write_delimited(
    df: DataFrame, path: str, sep: str = "\t", header: bool = True, mode: str = "overwrite", files: int | None = None
) -> str:
    """Write delimited text (a folder of part files).

    ``files=None`` keeps the data's parallelism; ``files=1`` funnels all rows through one task and is
    only for small outputs, so it is opt-in, never the default.
    """
    out = df.coalesce(files) if files else df
    out.write.option("sep", sep).option("header", str(header).lower()).mode(mode).csv(path)
    return path


def verify_roundtrip(df: DataFrame, path: str, sep: str = "\t") -> DataFrame:
    """Re-read a written folder and compare with ``df``: ``check, expected, actual, ok``.

    Compares column names and row counts (a row whose only field is null becomes a blank line that
    the reader skips, so counts can differ legitimately on one-column data).
    """
    spark = df.sparkSession
    back = spark.read.option("sep", sep).option("header", "true").csv(path)
    expected_cols = ",".join(df.columns)
    actual_cols = ",".join(back.columns)
    counts = (
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows").alias("check"), F.col("n").cast("string").alias("expected"))
    )
    n_back = back.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    counts = counts.withColumn("actual", F.lit(str(n_back)))
    names = spark.createDataFrame([("columns", expected_cols, actual_cols)], "check string, expected string, actual string")
    return counts.unionByName(names).withColumn("ok", F.col("expected") == F.col("actual"))


#: Name of the digest over whole rows among the digests by column.
WHOLE_ROW = "(row)"


def content_digests(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``column, n_rows, digest``: for each column, and for whole rows, the sum of the values' 64-bit hashes.

    The sum does not depend on the order or the partitioning of the rows, counts repeated values each time, and is taken in one
    pass with a map-side partial; nulls have a hash of their own."""
    names = list(columns) if columns is not None else df.columns
    of_row = F.xxhash64(*map(qcol, names), *(qcol(c).isNull() for c in names))
    parts = []
    for i, (name, value) in enumerate([*((c, F.xxhash64(qcol(c), qcol(c).isNull())) for c in names), (WHOLE_ROW, of_row)]):
        aggs = [F.sum(value.cast("decimal(20,0)")).alias(f"d{i}"), F.count(F.lit(1)).alias(f"n{i}")]
        cells = (F.lit(name).alias("column"), F.col(f"n{i}").alias("n_rows"), F.coalesce(F.col(f"d{i}"), F.lit(0)).cast("decimal(38,0)").alias("digest"))
        parts.append((aggs, F.struct(*cells)))
    return long_form(df, parts, "column string, n_rows bigint, digest decimal(38,0)")


def verify_content(df: DataFrame, path: str, sep: str = "\t") -> DataFrame:
    """Re-read a written folder with the schema of ``df`` and compare contents: ``column, n_rows, n_read, ok``, a row per column and one
    for whole rows.  A changed cell turns its column's ``ok`` and that of the whole rows false."""
    back = read_delimited(df.sparkSession, path, sep, schema=df.schema)
    there = content_digests(back).select("column", F.col("n_rows").alias("n_read"), F.col("digest").alias("read"))
    return content_digests(df).join(F.broadcast(there), "column").select(  # one row per column on both sides
        "column", "n_rows", "n_read", ((F.col("digest") == F.col("read")) & (F.col("n_rows") == F.col("n_read"))).alias("ok")
    )

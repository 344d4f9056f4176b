"""Session-level helpers: shared checkpoint folder and scratch paths.

The checkpoint folder comes from the session (``spark.checkpoint.dir`` or an earlier
``setCheckpointDir``).  Only a local-mode session without one gets a private folder, which is what
tests use; a cluster session without the setting is an error rather than a silent machine-local path.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tabsift-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder every executor can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never a machine-local temp folder)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tabsift-{name}-{uuid.uuid4().hex[:12]}"


#: Columns from which on a row's work no longer fits one method that the JVM compiles.
WIDE = 24
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def compile_wide(df: DataFrame) -> DataFrame:
    """``df``; if it is wide, its session gives up whole-stage code beyond 8000 bytes of bytecode a method, as Spark's manual advises for
    HotSpot: larger methods stay interpreted, whereas without whole-stage code a row's work is spread over small ones.  A limit that
    the user has set is kept."""
    conf = df.sparkSession.conf
    if len(df.columns) >= WIDE and conf.get(_METHOD_LIMIT) == "65535":
        conf.set(_METHOD_LIMIT, "8000")
    return df


def compiled_apart(df: DataFrame) -> DataFrame:
    """``df`` with its tasks as they are, its columns compiled apart from what is built on them: in one piece with them, an explode of a
    wide table would be too large to be compiled."""
    return df.coalesce(df.rdd.getNumPartitions())


#: Rows of a task of a table that :func:`spread` deals anew.
SPREAD_ROWS = 100_000


def spread(df: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """``df``, for a scan before costly work on each row: dealt round-robin into tasks of ``rows`` rows if its files give fewer than three
    tasks a core, as a row group is the least that a scan can split.  A table of one such task stays as it lies.  Put it before columns
    are added: what the later steps do not read is not moved."""
    if df.rdd.getNumPartitions() >= 3 * df.sparkSession.sparkContext.defaultParallelism:
        return df
    tasks = math.ceil(df.count() / rows)  # of a Parquet table a look at its footers
    return df.repartition(tasks) if tasks > 1 else df


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage of a derived DataFrame by writing it as a Parquet table in the shared folder.

    Used for tables that are read by several later steps, so the work behind them runs once and a lost
    executor re-reads the table instead of recomputing from the source.  A Parquet write is a single
    job (an eager ``checkpoint()`` computes and then writes in two), is compressed and columnar, and
    later passes read only the columns they use.  Column metadata (ML attributes) travels in the
    footer.  A schema Parquet cannot hold falls back to a reliable ``checkpoint()``.
    """
    from pyspark.errors import AnalysisException

    spark = df.sparkSession
    path = scratch_path(spark, "table")
    try:
        df.write.parquet(path)
    except AnalysisException:
        return df.checkpoint(eager=True)
    return spark.read.parquet(path)


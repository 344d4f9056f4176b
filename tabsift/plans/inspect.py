"""Plan inspection used by tests and the benchmark: what a query will do before it runs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The executed-plan text (as ``explain()`` prints it), without printing."""
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def uses_python_udf(df: DataFrame) -> bool:
    plan = physical_plan(df)
    return any(tok in plan for tok in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas"))


def shuffle_count(df: DataFrame) -> int:
    return physical_plan(df).count("Exchange hashpartitioning") + physical_plan(df).count("Exchange rangepartitioning")

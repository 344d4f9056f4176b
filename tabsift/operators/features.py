"""Scaling, PCA and importances.

Fits are MLlib estimators (distributed statistics; PCA's n x n decomposition on the driver is O(n^2)
in the *feature count*, not in rows).  Model-sized outputs -- importances, loadings, explained
variance -- are returned as DataFrames so they can be joined, ranked and stored like any result.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import PCA, PCAModel, StandardScaler, StandardScalerModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsift.operators.encode import assemble, slot_names, slot_sources, vector_size
from tabsift.operators.statistics import literal_rows


def standardize(
    train: DataFrame,
    input_col: str = "features",
    output_col: str = "scaled_features",
    with_mean: bool = True,
    with_std: bool = True,
) -> StandardScalerModel:
    """fit mean/sample-stddev scaling on ``train``; a zero-stddev slot maps to 0.0."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean, withStd=with_std).fit(train)


def clamp_k(k: int, n_features: int) -> int:
    """PCA cannot have more components than features."""
    if k > n_features:
        warnings.warn(f"PCA k={k} exceeds the {n_features} features; using k={n_features}")
        return n_features
    return k


def pca_stage(k: int, n_features: int, input_col: str = "scaled_features", output_col: str = "pca_features") -> PCA:
    return PCA(k=clamp_k(k, n_features), inputCol=input_col, outputCol=output_col)


def pca(train: DataFrame, k: int, input_col: str = "scaled_features", output_col: str = "pca_features") -> PCAModel:
    """fit PCA with k clamped to the vector size (read from metadata, no job)."""
    return pca_stage(k, vector_size(train, input_col), input_col, output_col).fit(train)


def explained_variance(spark: SparkSession, model: PCAModel) -> DataFrame:
    """F8/A5: ``component, ratio, cumulative`` -- k rows (k <= feature count)."""
    ratios = [float(x) for x in model.explainedVariance.toArray()]
    df = spark.createDataFrame(list(enumerate(ratios)), "component int, ratio double")
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("cumulative", F.sum("ratio").over(w))


def pca_loadings(spark: SparkSession, model: PCAModel, names: Sequence[str]) -> DataFrame:
    """``feature, component, loading`` for the n x k principal-component matrix."""
    pc = model.pc.toArray()
    rows = [(names[i], j, float(pc[i, j])) for i in range(pc.shape[0]) for j in range(pc.shape[1])]
    return spark.createDataFrame(rows, "feature string, component int, loading double")


def _ranked(df: DataFrame, value_col: str) -> DataFrame:
    w = Window.orderBy(F.col(value_col).desc(), F.col("feature"))
    return df.withColumn("rank", F.row_number().over(w))


def importance_table(spark: SparkSession, importances: Sequence[float], names: Sequence[str]) -> DataFrame:
    """``feature, importance, rank`` (1 = most important; ties by name)."""
    if len(importances) != len(names):
        raise ValueError(f"{len(importances)} importances for {len(names)} names")
    rows = [(n, float(v)) for n, v in zip(names, importances)]
    return _ranked(spark.createDataFrame(rows, "feature string, importance double"), "importance")


def feature_importance(model: RandomForestClassificationModel, df: DataFrame, features_col: str | None = None) -> DataFrame:
    """importances named by the *slots* of the assembled vector in ``df`` (not by input columns,
    which mislabels one-hot blocks, D8).  For scaled/PCA vectors pass the unscaled assembled frame."""
    features_col = features_col or model.getFeaturesCol()
    names = slot_names(df, features_col)
    return importance_table(df.sparkSession, model.featureImportances.toArray().tolist(), names)


def backproject_importance(
    spark: SparkSession, pca_model: PCAModel, forest: RandomForestClassificationModel, names: Sequence[str]
) -> DataFrame:
    """importance of input feature f = sum over components c of |loading[f, c]| * imp[c]
    (the reference multiplied the transposed matrix, D9).  ``feature, importance, rank``."""
    loadings = pca_loadings(spark, pca_model, names)
    imp = forest.featureImportances.toArray().tolist()
    comp = spark.createDataFrame([(j, float(v)) for j, v in enumerate(imp)], "component int, importance double")
    # both sides hold n*k and k rows (model-sized, bounded by the feature count)
    joined = loadings.join(F.broadcast(comp), "component")
    summed = joined.groupBy("feature").agg(F.sum(F.abs("loading") * F.col("importance")).alias("importance"))
    return _ranked(summed, "importance")


def column_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """F9/F11 rolled up to input columns: ``column, importance, share, n_slots, rank`` of a fitted pipeline.

    A categorical column has the sum over its slots; through a PCA a slot has its back-projected importance.  ``share`` is the part of
    the total."""
    slots = slot_sources(model)
    values = model.stages[-1].featureImportances.toArray()
    for stage in model.stages:
        if isinstance(stage, PCAModel):
            values = abs(stage.pc.toArray()) @ values
    rows = [(column, float(v)) for (_, column), v in zip(slots, values)]
    by_column = literal_rows(spark, rows, "column string, value double").groupBy("column")
    summed = by_column.agg(F.sum("value").alias("importance"), F.count("*").alias("n_slots"))
    whole = Window.partitionBy()
    ranked = summed.withColumn("share", F.col("importance") / F.sum("importance").over(whole))
    rank = F.row_number().over(Window.orderBy(F.col("importance").desc(), F.col("column")))
    return ranked.select("column", "importance", "share", "n_slots", rank.alias("rank"))


def select_top_columns(
    train: DataFrame,
    numerics: Sequence[str],
    categoricals: Sequence[str],
    label: str,
    n: int = 50,
    weight: str | None = None,
    invalid: str = "error",
    num_trees: int = 50,
    max_depth: int = 5,
    seed: int = 42,
) -> tuple[list[str], list[str], DataFrame]:
    """F10 over columns that include categories: the numeric and the categorical columns among the ``n`` most important, in rank order, and
    the table of importances."""
    from tabsift.operators.model import fit_config
    from tabsift.spec import ForestConfig

    config = ForestConfig("selection", num_trees=num_trees, max_depth=max_depth, seed=seed)
    table = column_importance(train.sparkSession, fit_config(train, config, numerics, label, weight, categoricals, invalid))
    top = [r["column"] for r in table.where(F.col("rank") <= n).orderBy("rank").collect()]
    cats = set(categoricals)
    return [c for c in top if c not in cats], [c for c in top if c in cats], table


def select_top_features(
    train: DataFrame,
    cols: Sequence[str],
    label: str,
    n: int = 50,
    weight: str | None = None,
    num_trees: int = 50,
    max_depth: int = 5,
    seed: int = 42,
) -> tuple[list[str], DataFrame]:
    """fit a forest on ``cols`` and keep the ``n`` most important (all when fewer).

    Returns the names (in rank order) and the full importance table.  ``weight`` optionally applies the
    class weights the final model uses (D16).
    """
    from tabsift.operators.model import train_forest

    cols = list(cols)
    assembled = assemble(train, cols, "features")
    model = train_forest(assembled, label, "features", weight=weight, num_trees=num_trees, max_depth=max_depth, seed=seed)
    table = feature_importance(model, assembled, "features")
    top = [r["feature"] for r in table.where(F.col("rank") <= n).orderBy("rank").collect()]
    return top, table

"""Random-forest fit, configurations, scoring and persistence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsift.functions.exprs import qcol
from tabsift.operators.encode import encoder_stages, slot_sources
from tabsift.operators.features import pca_stage
from tabsift.spec import ForestConfig


def forest_estimator(
    label: str,
    features_col: str,
    weight: str | None = None,
    num_trees: int = 35,
    max_depth: int = 10,
    seed: int = 42,
    max_bins: int = 32,
) -> RandomForestClassifier:
    """M1: ``weightCol`` is set only when a weight column is given (``None`` fails in fit, D6)."""
    rf = RandomForestClassifier(
        labelCol=label, featuresCol=features_col, numTrees=num_trees, maxDepth=max_depth, seed=seed, maxBins=max_bins
    )
    if weight:
        rf.setWeightCol(weight)
    return rf


def train_forest(
    train: DataFrame,
    label: str,
    features_col: str = "features",
    weight: str | None = None,
    num_trees: int = 35,
    max_depth: int = 10,
    seed: int = 42,
    max_bins: int = 32,
) -> RandomForestClassificationModel:
    """M1: distributed forest fit (histogram aggregation per tree level on the executors)."""
    return forest_estimator(label, features_col, weight, num_trees, max_depth, seed, max_bins).fit(train)


def forest_stages(
    config: ForestConfig, n_features: int, label: str, weight: str | None = None, features_col: str = "features"
) -> list:
    """Fresh stages for one configuration over an assembled vector: [scale] -> [PCA] -> forest.

    Built per call, never appended to a caller's list (D19) nor shared between configs (D20)."""
    stages, current = [], features_col
    if config.scale:
        stages.append(StandardScaler(inputCol=current, outputCol="scaled_features", withMean=True, withStd=True))
        current = "scaled_features"
    if config.pca_k:
        stages.append(pca_stage(config.pca_k, n_features, current, "pca_features"))
        current = "pca_features"
    stages.append(
        forest_estimator(label, current, weight, config.num_trees, config.max_depth, config.seed, config.max_bins)
    )
    return stages


def config_stages(config: ForestConfig, feature_cols: Sequence[str], label: str, weight: str | None = None) -> list:
    """Fresh stages for one configuration over numeric columns: assemble -> [scale] -> [PCA] -> forest."""
    return [*encoder_stages(feature_cols), *forest_stages(config, len(feature_cols), label, weight)]


def fit_encoder(train: DataFrame, numerics: Sequence[str], categoricals: Sequence[str] = (), invalid: str = "error") -> PipelineModel:
    """F1-F3 fitted on the training rows: index -> one-hot -> assemble."""
    return Pipeline(stages=encoder_stages(numerics, categoricals, "features", invalid)).fit(train)


def fit_config(
    train: DataFrame,
    config: ForestConfig,
    feature_cols: Sequence[str],
    label: str,
    weight: str | None = None,
    categoricals: Sequence[str] = (),
    invalid: str = "error",
    encoder: PipelineModel | None = None,
    encoded: DataFrame | None = None,
) -> PipelineModel:
    """M3: fit the whole configuration on the training rows; the model holds every stage from raw columns to the forest.

    ``encoder`` (from :func:`fit_encoder`) saves fitting it again for each configuration, and ``encoded``, the training rows as it
    transforms them, encoding them in each pass of the fits."""
    encoder = encoder or fit_encoder(train, feature_cols, categoricals, invalid)
    stages = forest_stages(config, len(slot_sources(encoder)), label, weight)
    fitted = Pipeline(stages=stages).fit(encoder.transform(train) if encoded is None else encoded)
    return PipelineModel(stages=[*encoder.stages, *fitted.stages])


def forest_of(model: PipelineModel) -> RandomForestClassificationModel:
    return model.stages[-1]


def score(model: PipelineModel, df: DataFrame, label: str, key: str | None = None) -> DataFrame:
    """M4: ``[key,] label, prediction, probability`` (probability as ``array<double>``)."""
    out = model.transform(df)
    cols = ([qcol(key)] if key else []) + [
        qcol(label),
        F.col("prediction"),
        vector_to_array(F.col("probability")).alias("probability"),
    ]
    return out.select(*cols)


def save_model(model: PipelineModel, path: str) -> str:
    """Persist a fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load a pipeline saved by :func:`save_model`."""
    return PipelineModel.load(path)

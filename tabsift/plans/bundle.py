"""Durable runs (S6, M10): everything a run learned, in one folder, so that it can be resumed and used to score raw tables.

A bundle holds the fingerprint of its input, the cleaner, the label index, the columns in use, and for each finished configuration
its pipeline and scores.  A configuration counts as finished once its scores are written, which happens last.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsift.functions.exprs import qcol
from tabsift.operators import clean as C
from tabsift.operators.evaluate import compare_configs
from tabsift.operators.fitted import CleanerModel
from tabsift.operators.split import assign_split
from tabsift.plans.recipes import HALF, clean, distinct_written, normalize, prepare
from tabsift.sources.delimited import WHOLE_ROW, content_digests
from tabsift.spec import ForestConfig, TableSpec, default_configs


class Bundle:
    """A run's folder; paths go to Spark and its file system unchanged."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def has(self, name: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def put(self, name: str, value: dict) -> None:
        self.spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/{name}")

    def get(self, name: str) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/{name}").first()[0])

    def finished(self) -> list[str]:
        return [c for c in self.get("run")["configs"] if self.has(f"configs/{c}/scores/_SUCCESS")] if self.has("run/_SUCCESS") else []

    def scores(self) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.path}/configs/{c}/scores" for c in self.finished()))

    def model(self, config: str) -> PipelineModel:
        return PipelineModel.load(f"{self.path}/configs/{config}/model")


def fingerprint(df: DataFrame) -> dict:
    """Names, types, row count and order-free content digest of a table."""
    row = content_digests(df).where(F.col("column") == WHOLE_ROW).first()
    return {"columns": [list(t) for t in df.dtypes], "rows": row["n_rows"], "digest": str(row["digest"])}


def run_bundle(
    raw: DataFrame,
    spec: TableSpec,
    path: str,
    configs: Sequence[ForestConfig] | None = None,
    select_n: int | None = 50,
    metrics: Sequence[str] = ("weightedPrecision", "f1"),
    weighted: bool = True,
) -> Bundle:
    """E4 from the raw table into a bundle at ``path``.  If there is one of the same input and columns, what it learned is used again and
    its finished configurations are skipped; a bundle of another input is refused."""
    bundle, configs = Bundle(raw.sparkSession, path), list(configs) if configs is not None else default_configs()
    mark = fingerprint(raw)
    if bundle.has("run/_SUCCESS") and bundle.get("run")["input"] != mark:
        raise ValueError(f"{path} holds a run of another input")
    todo = [c for c in configs if c.name not in bundle.finished()]
    if not todo:
        return bundle
    df = normalize(raw, spec)
    if bundle.has("run/_SUCCESS"):
        df = C.cast_to_schema(df, spec.schema) if spec.schema is not None else df
        cleaner, known = CleanerModel.load(f"{path}/cleaner"), bundle.get("run")
        halved = distinct_written(assign_split(df, spec.key, spec.split_ratio, spec.seed, HALF))  # as clean does
        prepared = prepare(cleaner.transform(halved.drop(HALF)), spec, select_n=None, categoricals="encode", invalid="skip")
        features, cats = known["features"], known["categoricals"]
    else:
        cleaned = clean(df, spec, fit_on="train")
        prepared = prepare(cleaned.df, spec, select_n=select_n, categoricals="encode", invalid="skip")
        features, cats = prepared.features, prepared.categoricals
        cleaned.model.write().overwrite().save(f"{path}/cleaner")
        prepared.indexer.write().overwrite().save(f"{path}/label")
    names = [*(bundle.get("run")["configs"] if bundle.has("run/_SUCCESS") else []), *(c.name for c in todo)]
    bundle.put("run", {"input": mark, "label": spec.label, "features": features, "categoricals": cats, "configs": list(dict.fromkeys(names))})
    for config in todo:
        scores, models = compare_configs(
            prepared.train, prepared.test, [config], features, prepared.label_col,
            weight="class_weight" if weighted else None, metrics=metrics, cache=False, categoricals=cats, invalid="skip",
        )
        if models[config.name] is None:
            raise RuntimeError(f"{config.name}: {scores.first()['error']}")
        models[config.name].write().overwrite().save(f"{path}/configs/{config.name}/model")
        scores.write.mode("overwrite").parquet(f"{path}/configs/{config.name}/scores")
    return bundle


def score_raw(bundle: Bundle, raw: DataFrame, spec: TableSpec, config: str) -> DataFrame:
    """``[key,] label, predicted, probability`` of every row of a raw table, by what a bundle learned: normalise -> cast -> clean ->
    encode -> predict.  Rows are neither dropped nor de-duplicated; a label the run did not know is still shown."""
    df = normalize(raw, spec)
    df = C.cast_to_schema(df, spec.schema) if spec.schema is not None else df
    cleaned = CleanerModel.load(f"{bundle.path}/cleaner").transform(df)
    cleaned = C.cast_columns(cleaned, bundle.get("run")["features"], "double")
    scored = bundle.model(config).transform(cleaned)
    labels = StringIndexerModel.load(f"{bundle.path}/label").labelsArray[0]
    named = IndexToString(inputCol="prediction", outputCol="predicted", labels=list(labels)).transform(scored)
    keys = [qcol(spec.key)] if spec.key else []
    return named.select(*keys, qcol(spec.label), "predicted", vector_to_array(F.col("probability")).alias("probability"))

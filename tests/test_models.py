"""Property checks for the model operators."""

import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tabsift.operators.encode import assemble, slot_names
from tabsift.operators.evaluate import compare_configs, evaluate
from tabsift.operators.features import (
    backproject_importance,
    explained_variance,
    feature_importance,
    pca,
    select_top_features,
    standardize,
)
from tabsift.operators.model import fit_config, forest_of, load_model, save_model, score, train_forest
from tabsift.plans.recipes import prepare, run
from tabsift.session import scratch_path
from tabsift.sources.fixtures import document_features, load_table
from tabsift.spec import ForestConfig, TableSpec, default_configs

SPEC = TableSpec(label="lang", key="doc_id")


@pytest.fixture(scope="module")
def prepared(spark, sf):
    docs = document_features(load_table(spark, sf, "documents")).coalesce(2)
    return prepare(docs, SPEC, select_n=None)


@pytest.fixture(scope="module")
def planted(spark):
    # label decided by `signal` alone; `noise` is a hash of the id
    df = spark.range(0, 600).select(
        F.col("id"),
        (F.col("id") % 3).cast("double").alias("signal"),
        (F.abs(F.hash("id")) % 97).cast("double").alias("noise"),
    ).withColumn("label", F.col("signal"))
    return df.coalesce(2)


def test_importances_sum_to_one_and_rank(planted):
    top, table = select_top_features(planted, ["noise", "signal"], "label", n=1, num_trees=10)
    assert top == ["signal"]
    rows = table.collect()
    assert abs(sum(r["importance"] for r in rows) - 1.0) < 1e-9
    assert all(r["importance"] >= 0 for r in rows)
    assert {r["rank"] for r in rows} == {1, 2}


def test_fewer_columns_than_n(planted):
    top, _ = select_top_features(planted, ["noise", "signal"], "label", n=50, num_trees=5)
    assert sorted(top) == ["noise", "signal"]


def test_probabilities_and_predictions(prepared):
    model = fit_config(prepared.train, ForestConfig("raw", num_trees=10), prepared.features, prepared.label_col)
    scored = score(model, prepared.test, prepared.label_col, key="doc_id").collect()
    k = len(prepared.indexer.labelsArray[0])
    for r in scored:
        assert abs(sum(r["probability"]) - 1.0) < 1e-9
        assert len(r["probability"]) == k  # no extra "unknown" class (D17)
        assert r["prediction"] in {float(i) for i in range(k)}


def test_same_seed_same_model(prepared):
    a = fit_config(prepared.train, ForestConfig("raw", num_trees=5), prepared.features, prepared.label_col)
    b = fit_config(prepared.train, ForestConfig("raw", num_trees=5), prepared.features, prepared.label_col)
    assert forest_of(a).featureImportances == forest_of(b).featureImportances


def test_save_load_same_predictions(spark, prepared):
    model = fit_config(prepared.train, ForestConfig("raw", num_trees=5), prepared.features, prepared.label_col)
    loaded = load_model(save_model(model, scratch_path(spark, "test-model")))
    a = score(model, prepared.test, prepared.label_col, "doc_id").orderBy("doc_id").collect()
    b = score(loaded, prepared.test, prepared.label_col, "doc_id").orderBy("doc_id").collect()
    assert [r["prediction"] for r in a] == [r["prediction"] for r in b]


def test_weights_sum_to_n(prepared):
    n = prepared.train.count()
    assert abs(prepared.train.agg(F.sum("class_weight")).first()[0] - n) < 1e-6


def test_label_index_fit_on_train_only(prepared):
    # test rows are indexed with the train mapping (D15); labels all seen here, so no index K
    k = len(prepared.indexer.labelsArray[0])
    assert prepared.test.where(F.col("lang_index") >= k).count() == 0


def test_pca_ratios(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    vec = assemble(load_table(spark, sf, "lineitem").select(*cols), cols)
    scaled = standardize(vec).transform(vec)
    ev = explained_variance(spark, pca(scaled, k=len(cols))).orderBy("component").collect()
    ratios = [r["ratio"] for r in ev]
    assert ratios == sorted(ratios, reverse=True)
    assert abs(sum(ratios) - 1.0) < 1e-9 and abs(ev[-1]["cumulative"] - 1.0) < 1e-9


def test_pca_k_clamped(spark, sf):
    cols = ["l_quantity", "l_tax"]
    vec = assemble(load_table(spark, sf, "lineitem").select(*cols), cols)
    with pytest.warns(UserWarning):
        model = pca(vec, k=10, input_col="features")
    assert model.getK() == 2


def test_standardize_zero_std(spark):
    df = assemble(spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double"), ["a", "b"])
    out = standardize(df).transform(df).collect()
    got = [v for r in out for v in r["scaled_features"]]
    assert got == pytest.approx([-math.sqrt(0.5), 0.0, math.sqrt(0.5), 0.0], abs=1e-12)


def test_evaluate_equals_mllib(prepared):
    model = fit_config(prepared.train, ForestConfig("raw", num_trees=5, max_depth=3), prepared.features, prepared.label_col)
    pred = model.transform(prepared.test)
    ours = {r["metric"]: r["value"] for r in evaluate(pred, prepared.label_col).collect()}
    for m in ("weightedPrecision", "weightedRecall", "f1", "accuracy"):
        ref = MulticlassClassificationEvaluator(labelCol=prepared.label_col, metricName=m).evaluate(pred)
        assert abs(ours[m] - ref) < 1e-9, m


def test_evaluate_never_predicted_class(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 0.0), (2.0, 2.0)], "y double, prediction double")
    got = {r["metric"]: r["value"] for r in evaluate(df, "y").collect()}
    # class 1 never predicted: precision 0; class 0 precision 1/3; class 2 precision 1
    assert abs(got["weightedPrecision"] - (1 * (1 / 3) + 2 * 0 + 1 * 1) / 4) < 1e-12
    assert got["accuracy"] == 0.5


def test_compare_configs_rows_and_beats_majority(prepared):
    scores, models = compare_configs(
        prepared.train, prepared.test, default_configs(num_trees=10, max_depth=6, pca_k=4), prepared.features,
        prepared.label_col, "class_weight",
    )
    rows = scores.collect()
    assert len(rows) == 3 * 2 * 2 and all(r["status"] == "ok" for r in rows)
    assert {r["split"] for r in rows} == {"train", "test"}  # D10: train and test kept apart
    assert {r["config"] for r in rows} == {"without_normalization", "with_normalization", "with_normalization_pca"}
    majority = prepared.test.groupBy("lang_index").count().agg(F.max("count")).first()[0] / prepared.test.count()
    for r in rows:
        if r["split"] == "test" and r["metric"] == "f1":
            assert r["value"] > majority
    assert all(m is not None for m in models.values())


def test_failed_config_is_recorded(prepared):
    bad = ForestConfig("broken", num_trees=0)
    scores, models = compare_configs(prepared.train, prepared.test, [bad], prepared.features, prepared.label_col)
    rows = scores.collect()
    assert all(r["status"] == "failed" and r["value"] is None and r["error"] for r in rows)
    assert models["broken"] is None


def test_feature_importance_slot_names_one_hot(spark):
    from tabsift.operators.encode import fit_indexer, one_hot

    df = spark.createDataFrame([("a", 1.0, 0.0), ("b", 2.0, 1.0), ("c", 3.0, 1.0), ("a", 4.0, 0.0)],
                               "cat string, x double, y double")
    enc = one_hot(fit_indexer(df, ["cat"], "keep").transform(df), ["cat_index"])
    vec = assemble(enc, ["cat_vec", "x"])
    names = slot_names(vec, "features")
    assert names[-1] == "x" and len(names) == 4 and all(n.startswith("cat_vec") for n in names[:3])
    model = train_forest(vec, "y", num_trees=3, max_depth=2)
    assert feature_importance(model, vec).count() == 4


def test_backproject_hand_made(spark):
    """F11 against the formula: importance of f = sum_c |loading[f,c]| * imp[c]."""

    df = spark.createDataFrame([(float(i), float(2 * i % 7), float(i % 3)) for i in range(60)], "a double, b double, y double")
    vec = assemble(df, ["a", "b"])
    pm = pca(vec, k=2, input_col="features")
    proj = pm.transform(vec)
    forest = train_forest(proj, "y", "pca_features", num_trees=5, max_depth=3)
    got = {r["feature"]: r["importance"] for r in backproject_importance(spark, pm, forest, ["a", "b"]).collect()}
    pc = pm.pc.toArray()
    imp = forest.featureImportances.toArray()
    for i, name in enumerate(["a", "b"]):
        assert abs(got[name] - sum(abs(pc[i, j]) * imp[j] for j in range(2))) < 1e-12


def test_run_recipe(spark, sf):
    docs = document_features(load_table(spark, sf, "documents"))
    res = run(docs, SPEC, configs=default_configs(num_trees=5, max_depth=4, pca_k=3), select_n=5)
    assert len(res.prepared.features) == 5
    assert res.scores.count() == 12
    assert res.explained_variance.count() == 3

"""One regression per reference defect that applies to the build."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsift.operators import clean as C
from tabsift.operators import profile as P
from tabsift.operators.encode import assemble
from tabsift.operators.evaluate import evaluate
from tabsift.operators.model import config_stages, train_forest
from tabsift.plans.recipes import clean, normalize
from tabsift.spec import ForestConfig, TableSpec, default_configs, flow_schema, flow_spec


def test_d1_lowercase_is_null_safe(spark):
    df = spark.createDataFrame([("TCP",), (None,)], "proto string")
    assert [r["proto"] for r in C.lowercase(df, ["proto"]).collect()] == ["tcp", None]


def test_d3_d22_uncastable_counted_on_raw_text(spark):
    raw = spark.createDataFrame([("1",), ("-",), ("x",)], "a string")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert P.profile_uncastable(raw, schema).first()["n_uncastable"] == 2
    cast = C.cast_to_schema(raw, schema)  # try_cast: no ANSI error
    assert [r["a"] for r in cast.collect()] == [1, None, None]


def test_d4_impute_only_existing_numerics_with_per_column_fallback(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    with pytest.warns(UserWarning):
        out = C.impute(df, ["a", "b"]).collect()
    assert [r["a"] for r in out] == [1.0, 1.0, 3.0] and [r["b"] for r in out] == [0.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        C.impute(df, ["a", "proto_index"])


def test_d5_weighted_f1_metric_exists(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "y double, prediction double")
    assert evaluate(df, "y", metrics=["f1"]).first()["value"] == 1.0


def test_d6_no_weight_column(spark):
    df = assemble(spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)] * 5, "x double, y double"), ["x"])
    assert train_forest(df, "y", weight=None, num_trees=2).numClasses == 2


def test_d7_profile_skips_isnan_on_non_float(spark):
    df = assemble(spark.createDataFrame([(1.0, "a")], "x double, s string"), ["x"])
    got = {r["column"]: r["n_nan"] for r in P.profile_columns(df).collect()}
    assert got == {"x": 0, "s": 0, "features": 0}


def test_d11_d20_each_config_has_its_own_stages():
    cfgs = default_configs()
    assert len({c.name for c in cfgs}) == 3
    stages = [config_stages(c, ["a", "b", "c"], "y") for c in cfgs]
    assert [len(s) for s in stages] == [2, 3, 4]
    assert stages[1][1] is not stages[2][1]  # scaler not shared between configs


def test_f7_pca_k_clamped_in_config():
    stages = config_stages(ForestConfig("p", scale=True, pca_k=10), ["a", "b"], "y")
    assert stages[2].getK() == 2


def test_d23_categorical_sentinel_becomes_unknown(spark):
    df = spark.createDataFrame([(1, "-", "TCP"), (2, "DoS", "NULL")], "k int, Attack_type string, proto string")
    spec = TableSpec(label="Attack_type", key="k", categoricals=("proto",))
    out = clean(normalize(df, spec), spec, impute_exact=True).df.orderBy("k").collect()
    assert [r["Attack_type"] for r in out] == ["unknown", "dos"]
    assert [r["proto"] for r in out] == ["tcp", "unknown"]


def test_d24_zero_fill_keeps_int(spark):
    df = spark.createDataFrame([(None,), (2,)], "fwd_pkts_tot int")
    assert C.replace_non_finite(df, ["fwd_pkts_tot"], 0.0).dtypes == [("fwd_pkts_tot", "int")]


def test_flow_schema_declares_84_columns():
    s = flow_schema()
    kinds = [f.dataType.simpleString() for f in s.fields]
    assert len(s.fields) == 84 and kinds.count("string") == 3 and kinds.count("int") == 25 and kinds.count("double") == 56
    assert flow_spec().label == "Attack_type"


def test_flow_records_end_to_end(spark):
    """The reference's own record layout: raw strings with dotted names and sentinels -> clean."""
    names = [n.replace("_", ".", 1) if n == "id_orig_p" else n for n in flow_schema().names]
    row1 = ["80" if n not in ("proto", "service", "Attack_type") else v for n, v in
            zip(flow_schema().names, [None] * 84)]
    row1[2], row1[3], row1[83] = "TCP", "-", "DOS_SYN_Hping"
    row2 = list(row1)
    row2[4] = "nan"
    row2[5] = "-3"
    row2[83] = "MQTT_Publish"
    df = spark.createDataFrame([tuple(row1), tuple(row2)], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    spec = flow_spec()
    out = clean(normalize(df, spec), spec).df
    assert len(out.columns) == 84 and "id_orig_p" in out.columns
    rows = out.orderBy("Attack_type").collect()
    assert [r["service"] for r in rows] == ["unknown", "unknown"]
    assert {r["fwd_pkts_tot"] for r in rows} <= {0, 80}  # -3 clamped
    assert dict(out.dtypes)["fwd_pkts_tot"] == "int"


def test_d9_backproject_n_features_k_components(spark):
    from tabsift.operators.features import backproject_importance, pca

    rows = [(float(i), float(i * i % 11), float(i % 7), float(i % 2)) for i in range(80)]
    vec = assemble(spark.createDataFrame(rows, "a double, b double, c double, y double"), ["a", "b", "c"])
    pm = pca(vec, k=2, input_col="features")  # pc is 3 x 2
    forest = train_forest(pm.transform(vec), "y", "pca_features", num_trees=3, max_depth=2)
    out = backproject_importance(spark, pm, forest, ["a", "b", "c"]).collect()
    assert sorted(r["feature"] for r in out) == ["a", "b", "c"] and sorted(r["rank"] for r in out) == [1, 2, 3]


def test_d14_assembler_modes(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 1.0), (float("nan"), 0.0), (float("inf"), 1.0)], "x double, y double")
    with pytest.raises(Exception):
        assemble(df, ["x"], handle_invalid="error").collect()
    kept = assemble(df, ["x"], handle_invalid="skip").collect()
    assert len(kept) == 2 and kept[1]["features"][0] == float("inf")  # skip drops null/NaN, keeps Inf
    assert P.count_non_finite_rows(df, ["x"]).first()["n_non_finite"] == 3


def test_d16_selection_can_use_class_weights(spark):
    from tabsift.operators.features import select_top_features
    from tabsift.operators.weights import with_class_weight

    df = spark.range(0, 300).select(
        (F.col("id") % 3 == 0).cast("double").alias("y"), (F.col("id") % 3).cast("double").alias("s"),
        (F.col("id") % 7).cast("double").alias("z"))
    weighted = with_class_weight(df, "y")
    top, table = select_top_features(weighted, ["z", "s"], "y", n=1, weight="class_weight", num_trees=5)
    assert top == ["s"] and table.count() == 2


def test_d18_many_categories_one_hot_only(spark):
    from tabsift.operators.encode import fit_indexer, one_hot

    df = spark.range(0, 400).select((F.col("id") % 40).cast("string").alias("svc"),
                                     (F.col("id") % 40 < 20).cast("double").alias("y"))
    enc = one_hot(fit_indexer(df, ["svc"], "keep").transform(df), ["svc_index"])
    vec = assemble(enc, ["svc_vec"])  # one-hot only: no nominal index column, so no maxBins limit
    assert train_forest(vec, "y", num_trees=3, max_depth=4).numFeatures == 40


def _jobs(spark, fn):
    import uuid

    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = fn()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_flag_columns_do_not_stall_the_median(spark):
    from tabsift.operators.clean import medians

    df = spark.range(200_000).selectExpr(
        "cast(id % 2 as int) flag", "cast(id % 2 as double) half", "cast(id % 3 = 0 as int) third", "cast(id % 2 as decimal(10,2)) dec",
        "cast(case when id % 10 < 4 then 0 when id % 10 < 8 then 1000000000 else id end as bigint) ends",
    )
    got, jobs = _jobs(spark, lambda: medians(df, df.columns))
    assert (got["flag"], got["half"], got["third"], float(got["dec"])) == (0, 0.0, 0, 0.0)
    want = sorted(0 if i % 10 < 4 else 1000000000 if i % 10 < 8 else i for i in range(200_000))[99_999]
    assert got["ends"] == want
    one, jobs_one = _jobs(spark, lambda: medians(df, ["flag"]))
    assert one == {"flag": 0} and jobs_one <= 6 and jobs <= 40


def test_numeric_and_null_labels(spark):
    from tabsift.plans.recipes import clean, prepare
    from tabsift.spec import TableSpec

    rows = [(i, None if i % 9 == 0 else i % 3, float(i % 7), f"c{i % 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, y int, x double, c string")
    spec = TableSpec(label="y", key="id", categoricals=("c",))
    cleaned = clean(df, spec).df
    assert cleaned.where("y is null").count() == sum(r[1] is None for r in rows)
    prepared = prepare(df, spec, select_n=None)
    assert prepared.train.count() + prepared.test.count() == sum(r[1] is not None for r in rows)
    text = df.selectExpr("id", "cast(y as string) y", "x", "c")
    prepared = prepare(text, spec, select_n=None)
    assert prepared.train.count() + prepared.test.count() == len(rows) and "unknown" in prepared.indexer.labels


def test_split_ratio_is_not_rounded(spark):
    import pytest

    from tabsift.operators.split import split

    with pytest.raises(ValueError):
        split(spark.range(10), "id", 0.0004)


def test_run_reports(spark, sf):
    from tabsift.plans.recipes import run
    from tabsift.plans.registry import DOC_SPEC
    from tabsift.sources.fixtures import document_features, load_table

    docs = load_table(spark, sf, "documents")
    result = run(document_features(docs), DOC_SPEC, select_n=12)
    assert {r.status for r in result.scores.collect()} == {"ok"}
    assert {k for k, m in result.models.items() if m is not None} == set(result.importances)
    for table in result.importances.values():
        rows = table.collect()
        assert len(rows) == len(result.prepared.features) and all(r.importance >= 0 for r in rows)
    assert sum(r[1] for r in result.sizes.collect()) == docs.count()
    assert abs(sum(r.share for r in result.classes.collect()) - 1) < 1e-9

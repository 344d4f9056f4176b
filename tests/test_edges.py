"""Edge inputs written inline (FIXTURES D)."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsift.operators import clean as C
from tabsift.operators import profile as P
from tabsift.operators.encode import fit_indexer, index_categories, one_hot, with_handle_invalid
from tabsift.operators.split import assign_split, split
from tabsift.operators.weights import class_weights, with_class_weight

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [
        (1, None, "a", 1),
        (2, NAN, "-", None),
        (3, INF, "NaN", 3),
        (4, -INF, "null", -4),
        (5, 0.0, "NULL", 5),
        (6, -0.0, "", 6),
        (7, -2.5, None, 7),
        (8, 1.5, "nan", 8),
    ]
    return spark.createDataFrame(rows, "id int, x double, s string, i int")


def test_profile_columns_counts(mixed):
    got = {r["column"]: r for r in P.profile_columns(mixed).collect()}
    assert (got["x"]["n_null"], got["x"]["n_nan"], got["x"]["n_inf"]) == (1, 1, 2)
    assert got["s"]["n_null"] == 1 and got["s"]["n_sentinel"] == 3  # '-', 'null', 'nan' (case-sensitive)
    assert got["i"]["n_null"] == 1 and got["i"]["n_nan"] == 0
    ci = {r["column"]: r for r in P.profile_columns(mixed, ignore_case=True).collect()}
    assert ci["s"]["n_sentinel"] == 5


def test_profile_is_one_row_per_column_for_empty_table(spark):
    empty = spark.createDataFrame([], "a double, b string")
    rows = P.profile_columns(empty).collect()
    assert [(r["column"], r["n_null"]) for r in rows] == [("a", 0), ("b", 0)]
    assert P.profile_shape(empty).first()["n_rows"] == 0


def test_uncastable(spark):
    df = spark.createDataFrame([("1",), ("1.5",), ("x",), (None,), ("nan",), (" 2 ",)], "v string")
    schema = T.StructType([T.StructField("v", T.IntegerType())])
    assert P.profile_uncastable(df, schema).first()["n_uncastable"] == 3  # 1.5, x, nan
    top = P.sample_uncastable(df, "v", "int", n=2).collect()
    assert len(top) == 2 and all(r["n"] == 1 for r in top)


def test_replace_non_finite_keeps_types(mixed):
    out = C.replace_non_finite(mixed, ["x", "i"], 0)
    assert dict(out.dtypes)["i"] == "int" and dict(out.dtypes)["x"] == "double"
    xs = [r["x"] for r in out.orderBy("id").collect()]
    assert xs[:5] == [0.0, 0.0, 0.0, 0.0, 0.0] and xs[6] == -2.5


def test_fill_constant_typed(mixed):
    out = C.fill_constant(mixed, ["i", "x"], 0)
    assert dict(out.dtypes)["i"] == "int"
    assert out.where("i IS NULL").count() == 0
    assert out.where(F.isnan("x")).count() == 1  # NaN is not null


def test_clamp_passes_null_and_nan(mixed):
    out = {r["id"]: r["x"] for r in C.clamp_min(mixed, ["x"], 0).collect()}
    assert out[1] is None and math.isnan(out[2]) and out[4] == 0.0 and out[7] == 0.0 and out[3] == INF


def test_median_exact_lower_median(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 3, 2, 4, 6]] + [(None,), (NAN,)], "x double")
    assert C.medians(df, ["x"], exact=True) == {"x": 3.0}
    # a value held by most rows (a hot value) is still exact
    hot = spark.createDataFrame([(7,)] * 50 + [(1,)] * 10 + [(9,)] * 10, "x int")
    assert C.medians(hot, ["x"]) == {"x": 7}


def test_impute_all_null_column_falls_back(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, x double")
    with pytest.warns(UserWarning):
        out = C.impute(df, ["x"], "median")
    assert [r["x"] for r in out.collect()] == [0.0, 0.0]


def test_impute_int_stays_int(spark):
    df = spark.createDataFrame([(1,), (None,), (4,), (10,)], "x int")
    out = C.impute(df, ["x"], "median")
    assert dict(out.dtypes)["x"] == "int"
    assert sorted(r["x"] for r in out.collect()) == [1, 4, 4, 10]


def test_impute_approx_close(spark):
    df = spark.range(0, 10001).select(F.col("id").cast("double").alias("x"))
    assert abs(C.medians(df, ["x"], exact=False)["x"] - 5000) <= 20
    assert C.medians(df, ["x"], exact=True)["x"] == 5000.0


def test_constant_columns_and_drop(spark):
    df = spark.createDataFrame([(1.0, 7.0, None, NAN), (2.0, 7.0, None, 1.0)], "a double, c double, n double, z double")
    got = {r["column"]: r["is_constant"] for r in P.constant_columns(df).collect()}
    assert got == {"a": False, "c": True, "n": True, "z": False}
    assert C.drop_constant(df).columns == ["a", "z"]
    neu = C.neutralize_constant(df).collect()
    assert [r["c"] for r in neu] == [0.0, 0.0] and [r["n"] for r in neu] == [None, None]


def test_one_row_table_constant(spark):
    df = spark.createDataFrame([(3.0,)], "a double")
    assert P.constant_columns(df).first()["is_constant"] is True


def test_dedup(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None)], "k int, v string")
    assert C.deduplicate(df).count() == 2
    assert C.deduplicate(df, ["k"]).count() == 2


def test_normalize_names_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, c int")
    assert C.normalize_names(df).columns == ["a_b", "c"]
    with pytest.raises(ValueError):
        C.normalized_names(["a.b", "a_b"])
    with pytest.raises(ValueError):
        C.normalized_names(["A.b", "a_B"])


def test_dotted_names_work_everywhere(spark):
    df = spark.createDataFrame([(1.0, None)], "`a.b` double, `c.d` string")
    assert {r["column"] for r in P.profile_columns(df).collect()} == {"a.b", "c.d"}
    assert C.fill_constant(df, ["a.b"], 0).columns == ["a.b", "c.d"]


def test_check_schema(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("c", T.IntegerType())])
    got = {(r["column"], r["problem"]) for r in C.check_schema(df, schema).collect()}
    assert got == {("a", "type"), ("c", "missing"), ("b", "extra")}


def test_cast_to_schema_try_cast(spark):
    df = spark.createDataFrame([("1.5", "x", "keep")], "i string, d string, other string")
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("d", T.DoubleType())])
    r = C.cast_to_schema(df, schema).first()
    assert r["i"] is None and r["d"] is None and r["other"] == "keep"


def test_indexer_ties_unseen_and_null(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    model = fit_indexer(train, ["v"], "keep")
    assert list(model.labelsArray[0]) == ["c", "a", "b"]
    test = spark.createDataFrame([("z",), (None,), ("a",)], "v string")
    got = [r["v_index"] for r in model.transform(test).collect()]
    assert got == [3.0, 3.0, 1.0]
    strict = fit_indexer(train, ["v"], "error")
    assert [r["v_index"] for r in with_handle_invalid(strict, "keep").transform(test).collect()] == [3.0, 3.0, 1.0]


def test_one_hot_unknown_is_zeros(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "v string")
    model = fit_indexer(df, ["v"], "keep")
    unseen = model.transform(spark.createDataFrame([("q",), ("a",)], "v string"))
    vecs = one_hot(model.transform(df).unionByName(unseen), ["v_index"]).collect()
    assert all(r["v_vec"].size == 2 for r in vecs)
    assert vecs[3]["v_vec"].numNonzeros() == 0


def test_more_than_32_categories(spark):
    df = spark.createDataFrame([(f"c{i}",) for i in range(40)], "v string")
    assert index_categories(df, ["v"]).select(F.max("v_index")).first()[0] == 39.0


def test_class_weights_balanced_and_single_class(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "y string")
    w = {r["y"]: r["weight"] for r in class_weights(df, "y").collect()}
    assert w == {"a": 8 / (2 * 6), "b": 8 / (2 * 2)}
    out = with_class_weight(df, "y")
    assert abs(out.agg(F.sum("class_weight")).first()[0] - 8) < 1e-9  # sum of weights = N
    one = spark.createDataFrame([("a",)] * 3, "y string")
    assert class_weights(one, "y").first()["weight"] == 1.0


def test_with_class_weight_keeps_null_labels(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "y string")
    out = with_class_weight(df, "y")
    assert out.count() == 3 and out.where("class_weight IS NULL").count() == 0


def test_split_deterministic_and_whole(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    a = assign_split(df, "k").collect()
    b = assign_split(df.repartition(7), "k").collect()
    assert {r["k"]: r["split"] for r in a} == {r["k"]: r["split"] for r in b}
    train, test = split(df.unionByName(spark.createDataFrame([(None,)], "k bigint")), "k")
    assert train.count() + test.count() == 2001
    assert 0.75 < train.count() / 2001 < 0.85


def test_drop_non_finite_rows_on_vector(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),), (Vectors.dense([NAN, 1.0]),), (Vectors.dense([INF, 0.0]),)], ["v"])
    assert C.drop_non_finite_rows(df, "v").count() == 1
    assert P.count_non_finite_rows(df, "v").first()["n_non_finite"] == 2


@pytest.mark.parametrize("pick_limit", [50, 1_000_000])
def test_exact_median_narrowing_matches_sorting(spark, pick_limit):
    import random

    rnd = random.Random(7)
    rows = []
    for i in range(20000):
        hot = 42.0 if i % 3 == 0 else rnd.lognormvariate(0, 2)  # a third of rows hold one value
        rows.append((hot, rnd.randint(-1000, 1000) if i % 11 else None, rnd.random(), float(i % 5)))
    rows.append((float("inf"), 5, NAN, 1.0))
    df = spark.createDataFrame(rows, "h double, k int, u double, s double").repartition(5)
    got = C.medians(df, ["h", "k", "u", "s"], exact=True, pick_limit=pick_limit)
    for j, c in enumerate(["h", "k", "u", "s"]):
        vals = sorted(r[j] for r in rows if r[j] is not None and not (isinstance(r[j], float) and math.isnan(r[j])))
        assert got[c] == vals[math.ceil(len(vals) / 2) - 1], c


def test_constant_is_exact_across_partitions(spark):
    # many partitions, some empty: the float stddev of a repeated value can drift off 0
    df = spark.range(0, 150000, numPartitions=13).select(F.lit(7.0).alias("c"), F.col("id").cast("double").alias("x"))
    df = df.where(F.col("x") % 13 != 5).repartition(37)
    got = {r["column"]: r["is_constant"] for r in P.constant_columns(df).collect()}
    assert got == {"c": True, "x": False}
    inf = spark.createDataFrame([(INF,), (INF,)], "v double")
    assert P.constant_columns(inf).first()["is_constant"] is False  # stddev of Inf values is NaN

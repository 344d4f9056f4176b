"""What keeps wide and large tables within their limits: sizes of compiled methods, rows moved and written."""

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsift.operators import evaluate as E
from tabsift.operators import profile as P
from tabsift.operators import statistics as S
from tabsift.operators.model import fit_config
from tabsift.plans import recipes
from tabsift.plans.inspect import physical_plan
from tabsift.plans.recipes import HALF, clean, normalize, prepare
from tabsift.plans.registry import _flows
from tabsift.plans.registry_more import _flow_part
from tabsift.sources.flows import flow_records, flow_table_spec
from tabsift.spec import FLOW_COLUMNS, ForestConfig, TableSpec, flow_schema

JIT_LIMIT = 8000  # bytes of bytecode; HotSpot leaves larger methods interpreted


def method_sizes(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def lineitem(spark, n=40):
    i = F.col("id")
    return spark.range(n).select(
        i.alias("l_orderkey"), (i % 7).alias("l_partkey"), (i % 5).alias("l_suppkey"), (i % 4 + 1).cast("int").alias("l_linenumber"),
        (i % 50).cast("double").alias("l_quantity"), (i * 1.37).alias("l_extendedprice"), (i % 10 / 100).alias("l_discount"),
        (i % 8 / 100).alias("l_tax"), F.lit("A").alias("l_returnflag"),
    )


def test_f3_casts_of_a_wide_table_are_compiled(spark):
    raw = flow_records(lineitem(spark)).toDF(*FLOW_COLUMNS)
    sizes = method_sizes(spark, P.profile_uncastable(raw, flow_schema()))
    assert sizes and max(sizes) <= JIT_LIMIT


def test_f3_sentinels_are_counted_as_their_parse_would(spark):
    rows = [("-", "-"), ("nan", "nan"), ("null", "NaN"), (None, None), ("1", "1.5"), ("1.5", "x"), (" 2 ", "Infinity")]
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("d", T.DoubleType())])
    out = P.profile_uncastable(spark.createDataFrame(rows, "i string, d string"), schema)
    counted = {r["column"]: r["n_uncastable"] for r in out.collect()}
    df = spark.createDataFrame(rows, "i string, d string")
    plain = {f.name: df.where(P.uncastable(F.col(f.name), f.dataType)).count() for f in schema.fields}
    assert counted == plain and counted["d"] == 2  # '-' and 'x'; 'nan' is a number


def test_f1_clean_moves_no_row_that_is_single(spark):
    raw = flow_records(lineitem(spark))
    spec = flow_table_spec()
    single = clean(normalize(raw, spec), spec)
    assert single.df.count() == 40 and "Union" not in physical_plan(single.df)
    twice = clean(normalize(raw.unionByName(raw.limit(7)), spec), spec)
    plan = physical_plan(twice.df)
    assert "Union" in plan and "Exchange hashpartitioning" not in plan  # what is left of the repeated rows is a written table
    assert sorted(map(repr, twice.df.collect())) == sorted(map(repr, single.df.collect()))


def test_f2_wide_rows_are_compiled_in_small_methods(spark):
    raw = flow_records(lineitem(spark), with_key=True)
    spec = flow_table_spec(key="flow_id")
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    clean(normalize(raw, spec), spec)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == str(JIT_LIMIT)


def test_f4_f5_f6_the_split_is_worked_out_once(spark, sf, tmp_path):
    """Fits read the training half by its mark, not by a digest of every key in every pass."""
    lineitem(spark, 300).write.parquet(f"{tmp_path}/lineitem.parquet")
    part = _flow_part(spark, str(tmp_path))
    assert "split" not in part.columns and "l_quantity" not in physical_plan(part)
    spec = TableSpec(label="s", key="k", numerics=("x",))
    rows = [(k if k % 9 else None, float(k), "ab"[k % 2]) for k in range(200)]
    df = spark.createDataFrame(rows, "k int, x double, s string")
    prepared = prepare(df, spec, select_n=None)
    assert "md5" not in physical_plan(prepared.train) + physical_plan(prepared.test) and HALF not in prepared.train.columns
    plain = prepare(df, spec, select_n=None, checkpoint=False)
    for half in ("train", "test"):
        got, want = (sorted(map(repr, getattr(p, half).select("k", "x", "s").collect())) for p in (prepared, plain))
        assert got == want


def test_f1_a_table_of_one_row_group_is_dealt_over_tasks(spark, tmp_path):
    """A scan splits no row group, so work on each row of such a table would run in one task."""
    lineitem(spark, 250_000).coalesce(1).write.parquet(f"{tmp_path}/large/lineitem.parquet")
    lineitem(spark, 1000).coalesce(1).write.parquet(f"{tmp_path}/small/lineitem.parquet")
    flows = _flows(spark, f"{tmp_path}/large")
    sizes = [r["n"] for r in flows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 250_000 and max(sizes) <= 100_000
    assert "Exchange" not in physical_plan(_flows(spark, f"{tmp_path}/small"))


def test_f1_f2_a_median_of_many_values_takes_two_passes(spark, monkeypatch):
    df = spark.range(1_500_000).select((F.col("id") * 7919 % 1_500_007).cast("double").alias("x"))
    want = df.orderBy("x").offset(749_999).first()[0]
    monkeypatch.setattr(S, "_narrow", lambda *_: (_ for _ in ()).throw(AssertionError("a third pass")))
    assert S.StatisticsPlan(df).want(["x"], "median").collect()["x"]["median"] == want


def test_f2_a_large_wide_table_is_not_written_whole(spark, monkeypatch):
    raw, spec = flow_records(lineitem(spark)), flow_table_spec()
    twice = raw.unionByName(raw.limit(7))
    written = clean(normalize(raw, spec), spec)
    monkeypatch.setattr(recipes, "WRITTEN_BYTES", 1)
    single = clean(normalize(raw, spec), spec)
    assert written.df.inputFiles() and not single.df.inputFiles()
    assert (single.model.fills, single.constant) == (written.model.fills, written.constant)
    again = clean(normalize(twice, spec), spec)
    left = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in again.df.inputFiles() if "part-" in f})
    assert left.count() <= 14  # the 7 repeated rows, and their digests
    for other in (single, again):
        assert sorted(map(repr, other.df.collect())) == sorted(map(repr, written.df.collect()))


def test_f3_categories_are_encoded_once_for_all_fits(spark, monkeypatch):
    rows = [(float(i % 17), "abc"[i % 3], float(i % 2), 1.0 + i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "x double, c string, label double, w double").coalesce(1)
    train, test = df.where("x < 14"), df.where("x >= 14")
    configs = [ForestConfig("raw", num_trees=3, max_depth=3), ForestConfig("pca", scale=True, pca_k=2, num_trees=3, max_depth=3)]
    written, materialize = [], E.materialize
    monkeypatch.setattr(E, "materialize", lambda half: written.append(half.columns) or materialize(half))
    scores, models = E.compare_configs(train, test, configs, ["x"], "label", "w", cache=False, categoricals=["c"])
    assert written == [["label", "w", "features"], ["label", "features"]]
    got = {(r["config"], r["split"], r["metric"]): r["value"] for r in scores.collect()}
    for cfg in configs:
        plain = fit_config(train, cfg, ["x"], "label", "w", ["c"])
        for half, rows in (("train", train), ("test", test)):
            for model in (plain, models[cfg.name]):  # the model still takes rows as they were
                want = {r["metric"]: r["value"] for r in E.evaluate(model.transform(rows), "label").collect()}
                assert all(abs(got[cfg.name, half, m] - want[m]) < 1e-9 for m in ("weightedPrecision", "f1"))

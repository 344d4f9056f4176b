"""Fitted cleaning, shared statistics, encoders in the pipeline, stored state and resumable runs."""

import math
import threading
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabsift.operators import clean as C
from tabsift.operators import profile as P
from tabsift.operators.encode import category_ranks, encoder_stages, index_by_ranks, slot_sources
from tabsift.operators.evaluate import compare_configs, run_tagged
from tabsift.operators.features import column_importance, select_top_columns
from tabsift.operators.fitted import Cleaner, CleanerModel
from tabsift.operators.model import fit_config, forest_estimator
from tabsift.operators.sketches import quantile_state, rank_of, state_quantiles
from tabsift.operators.statistics import StatisticsPlan
from tabsift.plans.bundle import Bundle, run_bundle, score_raw
from tabsift.plans.inspect import physical_plan, uses_python_udf
from tabsift.plans.recipes import run_raw
from tabsift.plans.registry_more import DIRTY_SPEC
from tabsift.session import scratch_path
from tabsift.sources.delimited import content_digests, scan_delimited, verify_content, write_delimited
from tabsift.sources.fixtures import dirty_orders, load_table
from tabsift.spec import ForestConfig, TableSpec

NAN, INF = float("nan"), float("inf")
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
doubles = st.one_of(st.none(), st.just(NAN), st.just(INF), st.just(-INF), st.sampled_from([0.0, -0.0, 1.5, 7.0]), st.floats(-1e6, 1e6))


def jobs(spark, action):
    sc, group = spark.sparkContext, f"g{time.time_ns()}"
    sc.setJobGroup(group, group)
    try:
        out = action()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(group))


# ---------------------------------------------------------------- statistics


def test_one_plan_serves_many_operators_in_few_jobs(spark):
    df = spark.range(5000).select(*[(F.col("id") % (i + 2)).cast("double").alias(f"c{i}") for i in range(120)], F.lit("x").alias("s"))
    plan = StatisticsPlan(df).want(df.columns, "rows", "null", "sentinel").want(df.columns[:-1], "null", "nan", "low", "high", "median")
    stats, n = jobs(spark, plan.collect)
    assert n <= 12  # two queries of three passes; under AQE each of their shuffles is a job, whatever the number of columns
    for i in (0, 7, 119):
        values = sorted(x % (i + 2) for x in range(5000))
        assert stats[f"c{i}"] == {"rows": 5000, "null": 0, "sentinel": 0, "nan": 0, "present": 5000, "low": 0.0, "high": float(i + 1), "median": values[2499]}
    assert stats["s"] == {"rows": 5000, "null": 0, "sentinel": 0}


@pytest.mark.parametrize("sketch_k,pick_limit", [(8, 5), (20, 100), (1000, 20_000)])
def test_medians_narrow_to_the_exact_value(spark, sketch_k, pick_limit):
    """Coarse sketches and a tiny last pass force narrowing and misses."""
    df = spark.range(30_000).selectExpr(
        "pow(id % 9973, 3) x", "cast(id * 7919 % 30011 - 15000 as bigint) * 1000000007 b", "cast(id % 777 as decimal(30,4)) / 7 d",
        "case when id % 3 = 0 then 5.0D else id % 100 end hot", "cast(id % 2 as int) flag", "if(id % 10 = 0, null, double('inf')) far",
        "if(id % 4 = 0, double('nan'), cast(id as double)) holes", "cast(null as double) none",
    )
    plan = StatisticsPlan(df, sketch_k=sketch_k, pick_limit=pick_limit).want(df.columns, "median")
    got = {c: s["median"] for c, s in plan.collect().items()}
    for c in df.columns:
        values = sorted(r[0] for r in df.select(c).collect() if r[0] is not None and not (isinstance(r[0], float) and math.isnan(r[0])))
        assert got[c] == (values[math.ceil(len(values) / 2) - 1] if values else None), c


def test_wide_profiles_equal_narrow_ones(spark):
    rows = [(None, NAN, 1, "-", True), (1.0, INF, None, "x", None), (-0.0, 2.0, 3, None, False)]
    few = spark.createDataFrame(rows, "a double, b float, c long, d string, e boolean")
    wide = few.select(*(F.col(c).alias(f"{c}{i}") for i in range(20) for c in few.columns))
    want = {r["column"]: tuple(r)[1:] for r in P.profile_columns(few).collect()}
    for df in (wide, wide.where("false")):
        got = P.profile_columns(df).collect()
        assert len(got) == 100
        for r in got:
            none = df is not wide
            assert tuple(r)[1:] == ((want[r["column"][0]][0], 0, 0, 0, 0) if none else want[r["column"][0]])
    constant = {r["column"]: r["is_constant"] for r in P.constant_columns(few.where("a is not null")).collect()}
    assert all(r["is_constant"] == constant[r["column"][0]] for r in P.constant_columns(wide.where("a0 is not null")).collect())


# ---------------------------------------------------------------- cleaner


@SETTINGS
@given(st.lists(st.tuples(doubles, st.one_of(st.none(), st.integers(-5, 5)), st.booleans()), max_size=40))
def test_cleaner_equals_the_steps(spark, rows):
    """Fitted on some rows and applied to all: the same as the separate steps with the statistics of those rows."""
    df = spark.createDataFrame(rows, "x double, k int, learn boolean")
    learn = df.where("learn")
    model = Cleaner(["x", "k"], nonNegative=["k"]).fit(learn)
    filled = C.replace_non_finite(C.impute(learn, ["x", "k"]), ["x", "k"], 0)
    assert sorted(model.constants) == sorted(C.constant_column_names(filled, ["x", "k"]))
    present = {c: sorted(r[i] for r in rows if r[2] and r[i] is not None and not math.isnan(r[i])) for i, c in ((0, "x"), (1, "k"))}
    median = {c: (v[math.ceil(len(v) / 2) - 1] if v else 0) for c, v in present.items()}

    def expected(c, v):
        if c in model.constants:
            return 0
        v = median[c] if v is None or math.isnan(v) else v
        v = 0 if math.isinf(v) else v
        return max(v, 0) if c == "k" else v

    got = sorted(map(tuple, model.transform(df).select("x", "k").collect()))
    assert got == sorted((expected("x", x), expected("k", k)) for x, k, _ in rows)


def test_cleaner_in_a_saved_pipeline(spark):
    train = spark.range(400).selectExpr("if(id % 5 = 0, null, id % 50) x", "concat('c', id % 3) c", "double(id % 2) y", "7 k")
    test = spark.createDataFrame([(None, "c1", 0.0, 3), (5, "new", 1.0, 7), (1, None, 0.0, None)], "x bigint, c string, y double, k int")
    stages = [Cleaner(["x", "k"], ["c"], unseen="fill"), *encoder_stages(["x", "k"], ["c"]), forest_estimator("y", "features", num_trees=3)]
    model = Pipeline(stages=stages).fit(train)
    path = scratch_path(spark, "pipeline")
    model.write().save(path)
    again = PipelineModel.load(path)
    assert isinstance(again.stages[0], CleanerModel) and again.stages[0].constants == ["k"] and again.stages[0].of("unseen") == "fill"
    show = lambda m: [tuple(r) for r in m.transform(test).select("x", "c", "k", "prediction").collect()]
    assert show(model) == show(again) and [r[1:3] for r in show(again)] == [("c1", 0), ("unknown", 0), ("unknown", 0)]
    assert slot_sources(again) == slot_sources(model) == [("x", "x"), ("k", "k")] + [(f"c=c{i}", "c") for i in range(3)]


def test_cleaner_strategies_and_errors(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (6, "b"), (None, "b")], "x int, c string")
    fill = lambda **kw: Cleaner(["x"], ["c"], **kw).fit(df).fills["x"]
    assert fill() == "2" and fill(strategy="mean") == "3" and fill(strategy="approx_median") == "2"
    assert [r.fill for r in Cleaner(["x"]).fit(df).learned(spark).collect()] == ["2"]
    with pytest.raises(ValueError):
        Cleaner(strategy="mode")
    with pytest.raises(ValueError):
        Cleaner(["x"]).fit(df).transform(df.drop("x"))
    empty = Cleaner(["x"], ["c"], unseen="fill").fit(df.where("false"))
    assert [tuple(r) for r in empty.transform(df).collect()] == [(0, "unknown")] * 4


# ---------------------------------------------------------------- encoders and importances


def test_unseen_and_null_categories_have_zeros(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "c string, x double")
    model = Pipeline(stages=encoder_stages(["x"], ["c"])).fit(train)
    other = spark.createDataFrame([("z", 1.0), (None, 1.0), ("b", 1.0)], "c string, x double")
    assert [r.features.toArray().tolist() for r in model.transform(other).collect()] == [[1, 0, 0], [1, 0, 0], [1, 0, 1]]


def test_importances_roll_up_to_columns(spark):
    df = spark.range(600).selectExpr("concat('c', id % 4) c", "double(id % 7) x", "rand(3) noise", "double(id % 4 = 2) y")
    for config in (ForestConfig("raw", num_trees=5), ForestConfig("pca", scale=True, pca_k=2, num_trees=5)):
        rows = column_importance(spark, fit_config(df, config, ["x", "noise"], "y", categoricals=["c"])).collect()
        assert {r.column: r.n_slots for r in rows} == {"c": 4, "x": 1, "noise": 1} and sum(r.share for r in rows) == pytest.approx(1)
    numbers, cats, _ = select_top_columns(df, ["x", "noise"], ["c"], "y", n=1, num_trees=5)
    assert (numbers, cats) == ([], ["c"])


def test_skipped_rows_do_not_fail_a_run(spark):
    df = spark.range(300).selectExpr("id", "if(id % 10 = 0, null, double(id % 5)) x", "concat('c', id % 2) c", "concat('l', id % 2) y")
    spec = TableSpec(label="y", key="id", categoricals=("c",))
    from tabsift.plans.recipes import run

    small = [ForestConfig("raw", num_trees=3)]
    assert {r.status for r in run(df, spec, small, select_n=None).scores.collect()} == {"failed"}
    result = run(df, spec, small, select_n=1, categoricals="encode", invalid="skip")
    assert {r.status for r in result.scores.collect()} == {"ok"}
    assert sum(r.n_invalid for r in result.prepared.skipped.collect()) == 30 and sum(r.n_rows for r in result.prepared.skipped.collect()) == 300


# ---------------------------------------------------------------- concurrent fits


def test_concurrent_fits_score_the_same(spark):
    df = spark.range(2000).selectExpr("double(id % 13) a", "double(id % 7) b", "double(id % 13 > 6) y")
    train, test = df.where("a != 3"), df.where("a = 3")
    configs = [ForestConfig(f"t{n}", num_trees=n) for n in (3, 4, 5)] + [ForestConfig("bad", max_depth=99)]
    show = lambda p: [tuple(r)[:4] + tuple(r)[5:6] for r in compare_configs(train, test, configs, ["a", "b"], "y", parallelism=p)[0].collect()]
    assert show(1) == show(3)


def test_an_interrupted_task_cancels_the_others(spark):
    started = threading.Event()

    def slow():
        started.set()
        return spark.range(40).repartition(8).rdd.map(lambda x: time.sleep(20)).count()

    def fail():
        started.wait(20)
        time.sleep(1)
        raise KeyboardInterrupt

    at = time.time()
    with pytest.raises(KeyboardInterrupt):
        run_tagged(spark, [("fail", fail), ("slow", slow)], 2)
    assert time.time() - at < 60


# ---------------------------------------------------------------- bundles


def test_a_killed_run_resumes(spark, sf, monkeypatch):
    raw, path = dirty_orders(load_table(spark, sf, "orders")), scratch_path(spark, "bundle")
    configs = [ForestConfig("one", num_trees=3, max_depth=3), ForestConfig("two", scale=True, num_trees=3, max_depth=3)]
    from tabsift.plans import bundle as B

    real, fitted = B.compare_configs, []

    def killed(train, test, own, *args, **kw):
        fitted.append(own[0].name)
        if len(fitted) == 2:
            raise KeyboardInterrupt
        return real(train, test, own, *args, **kw)

    monkeypatch.setattr(B, "compare_configs", killed)
    with pytest.raises(KeyboardInterrupt):
        run_bundle(raw, DIRTY_SPEC, path, configs)
    bundle = run_bundle(raw, DIRTY_SPEC, path, configs)
    assert fitted == ["one", "two", "two"] and bundle.finished() == ["one", "two"]
    assert {r.config for r in bundle.scores().collect()} == {"one", "two"}
    whole = run_raw(raw, DIRTY_SPEC, configs, invalid="skip")
    key = lambda rows: sorted((r.config, r.split, r.metric, round(r.value, 9)) for r in rows)
    assert key(bundle.scores().collect()) == key(whole.scores.collect())
    assert score_raw(Bundle(spark, path), raw, DIRTY_SPEC, "two").count() == raw.count()
    with pytest.raises(ValueError):
        run_bundle(raw.where("o_orderkey > 5"), DIRTY_SPEC, path, configs)


def test_a_file_becomes_scores_in_one_call(spark, sf):
    path = write_delimited(dirty_orders(load_table(spark, sf, "orders")), scratch_path(spark, "raw"))
    spec = TableSpec(label="status_txt", key="o_orderkey", categoricals=("priority",), schema=C.T._parse_datatype_string("qty_txt int, price_txt double, price_dbl double, cust_int int"), drop=("const_dbl", "empty_dbl"))
    result = run_raw(path, spec, [ForestConfig("raw", num_trees=3)])
    assert {r.status for r in result.scores.collect()} == {"ok"} and "priority" in [r.column for r in result.column_importances["raw"].collect()]


# ---------------------------------------------------------------- digests, rejects, ranks, sketches


@SETTINGS
@given(st.lists(st.tuples(doubles, st.one_of(st.none(), st.sampled_from(["", "a", "b"])), st.one_of(st.none(), st.integers(0, 2))), max_size=40))
def test_dedup_by_digest_equals_by_rows(spark, rows):
    df = spark.createDataFrame(rows, "x double, s string, k int")
    show = lambda d: sorted(map(repr, (tuple(0.0 if v == 0 else v for v in r) for r in d.collect())))
    want = show(df.dropDuplicates())
    assert show(C.deduplicate(df, by="digest")) == want and show(C.deduplicate(df, by="digest", max_broadcast_bytes=0)) == want


def test_dedup_by_digest_moves_only_repeated_rows(spark):
    df = spark.range(2000).selectExpr("id % 1990 id", "repeat('x', 50) wide")
    out = C.deduplicate(df, by="digest")
    assert out.count() == 1990
    plan = physical_plan(out)
    assert "Union" in plan and plan.count("Exchange hashpartitioning") == 1  # beneath it only rows whose digest was marked


def test_content_digests_find_one_changed_cell(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 1.5), (2, "b", 1.5), (None, "", NAN)], "k int, s string, x double")
    digest = lambda d: {r.column: (r.n_rows, r.digest) for r in content_digests(d).collect()}
    base = digest(df)
    assert digest(df.orderBy(F.col("x").desc()).repartition(3)) == base and digest(df.dropDuplicates()) != base
    changed = digest(df.withColumn("s", F.when(F.col("k") == 1, "A").otherwise(F.col("s"))))
    assert {c for c in base if changed[c] != base[c]} == {"s", "(row)"}
    swapped = digest(spark.createDataFrame([(1, "b", None), (2, "a", 1.5), (2, "b", 1.5), (None, "", NAN)], df.schema))
    assert {c for c in base if swapped[c] != base[c]} == {"(row)"}
    assert set(digest(df.where("false"))) == set(base)
    path = write_delimited(df, scratch_path(spark, "content"))  # an empty text is read back as null
    assert {r.column: r.ok for r in verify_content(df, path).collect()} == {"k": True, "s": False, "x": True, "(row)": False}
    whole = df.where("s != ''")
    path = write_delimited(whole, scratch_path(spark, "content"))
    assert {r.column: r.ok for r in verify_content(whole, path).collect()} == {c: True for c in base}


def test_rejects_are_counted_whole(spark):
    lines = ["id\tname\tsize", "1\ta\t10", "2\tb", "3\tc\t30\textra", "4\td\tbig", "5\t\t50"]
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    typed = scan_delimited(spark, path, schema="id int, name string, size int")
    assert sorted(r.id for r in typed.rows.collect()) == [1, 5] and typed.rows.count() == 2 and typed.rejects.count() == 3
    assert sorted(r.line for r in typed.rejects.collect()) == ["2\tb", "3\tc\t30\textra", "4\td\tbig"]
    assert typed.rows.select("name").count() == 2
    text = scan_delimited(spark, path)
    assert sorted(r.id for r in text.rows.collect()) == ["1", "4", "5"] and sorted(r.line for r in text.rejects.collect()) == ["2\tb", "3\tc\t30\textra"]


def test_ranks_of_many_categories(spark):
    df = spark.range(300_000).selectExpr("concat('c', id % 200000) c")
    ranks = category_ranks(df, "c")
    assert ranks.agg(F.count("*"), F.countDistinct("index"), F.min("index"), F.max("index")).first() == (200_000, 200_000, 0, 199_999)
    from pyspark.sql import Window

    want = df.groupBy("c").count().withColumn("want", F.row_number().over(Window.orderBy(F.col("count").desc(), "c")) - 1)
    assert ranks.join(want, ranks["value"] == want["c"]).where("index = want").count() == 200_000
    more = df.unionByName(spark.createDataFrame([(None,), ("new",)], "c string"))
    for limit in (10**9, 100_000):  # broadcast whole; only the most frequent values broadcast
        out = index_by_ranks(more, "c", ranks, "i", limit)
        assert out.count() == 300_002 and out.where("i = 200000").count() == 2
        assert out.join(ranks, out["c"] == ranks["value"]).where("i = index").count() == 300_000
    assert not uses_python_udf(index_by_ranks(more, "c", ranks))


def test_sketch_states_merge(spark):
    df = spark.range(50_000).selectExpr("double(id) x", "if(id % 3 = 0, null, id % 100) k", "id % 4 part", "double('nan') none")
    state = quantile_state(df, ["x", "k", "none"], F.col("part"))
    assert {(r.part, r.column) for r in state.collect()} == {(str(p), c) for p in range(4) for c in ("x", "k")}
    for q in (0.1, 0.5, 0.99):
        for r in rank_of(df, state_quantiles(state, q)).collect():
            assert r.below <= (q + r.bound) * r.n + 1 and r.upto >= (q - r.bound) * r.n - 1

"""Plan checks: single pass, pruning/pushdown, broadcast only where bounded, no Python UDFs."""

import pytest
from pyspark.sql import functions as F

from tabsift.operators import clean as C
from tabsift.operators import profile as P
from tabsift.operators.split import assign_split
from tabsift.operators.weights import with_class_weight
from tabsift.plans.inspect import formatted_plan, physical_plan, uses_python_udf
from tabsift.plans.registry import ORACLE_SQL, QUERIES
from tabsift.sources.fixtures import load_table


def _jobs(spark, action):
    sc = spark.sparkContext
    group = f"g{id(action)}"
    sc.setJobGroup(group, group)
    try:
        action()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_profile_takes_a_few_passes_whatever_the_width(spark):
    wide = spark.range(0, 500).select(*[(F.col("id") * i).cast("double").alias(f"c{i}") for i in range(40)])
    one = _jobs(spark, lambda: P.profile_columns(wide).collect())
    loop = _jobs(spark, lambda: [wide.where(F.col(c).isNull()).count() for c in wide.columns])
    assert one <= 4 < loop
    plan = physical_plan(P.profile_columns(wide))
    assert plan.count("HashAggregate") == 2  # one partial + one final over the cells of all columns


def test_column_pruning_reaches_scan(spark, sf):
    li = load_table(spark, sf, "lineitem")
    plan = formatted_plan(P.profile_columns(li, ["l_quantity"]))
    assert "ReadSchema: struct<l_quantity:double>" in plan


def test_filter_pushdown_reaches_scan(spark, sf):
    li = load_table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    plan = formatted_plan(C.drop_non_finite_rows(li, ["l_quantity"]))
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan


def test_class_weight_join_is_broadcast(spark, sf):
    docs = load_table(spark, sf, "documents").select("doc_id", "lang")
    plan = physical_plan(with_class_weight(docs, "lang"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_class_weight_join_falls_back_to_shuffle_beyond_bound(spark, sf):
    docs = load_table(spark, sf, "documents").select("doc_id", "lang")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical_plan(with_class_weight(docs, "lang", max_broadcast_bytes=1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "BroadcastHashJoin" not in plan


def test_split_needs_no_shuffle(spark, sf):
    orders = load_table(spark, sf, "orders")
    assert "Exchange" not in physical_plan(assign_split(orders, "o_orderkey"))


def test_cleaning_is_one_projection(spark, sf):
    orders = load_table(spark, sf, "orders")
    out = C.replace_non_finite(C.fill_constant(orders, ["o_totalprice"], 0), ["o_totalprice"], 0)
    plan = physical_plan(out)
    # no shuffle, and every operator above the scan sits in one whole-stage-codegen stage "*(1)"
    import re

    assert "Exchange" not in plan
    assert set(re.findall(r"\*\((\d+)\)", plan)) == {"1"}


#: Queries that fit several models each; that they match is tested elsewhere, and what they are made of is tested here.
SLOW = ("bundle_scores", "encoded_", "run_raw_", "run_reports", "run_checks")


@pytest.mark.parametrize("name", [n for n in sorted(ORACLE_SQL) if not n.startswith(SLOW)] + ["score_lang"])
def test_no_python_udf(spark, sf, name):
    assert not uses_python_udf(QUERIES[name](spark, sf))


def test_materialize_writes_under_the_shared_checkpoint_folder(spark, sf):
    from tabsift.session import checkpoint_dir, materialize

    out = materialize(load_table(spark, sf, "orders").groupBy("o_orderstatus").count())
    def local(path):  # "file:/x" and "file:///x" name the same folder
        return "/" + path.removeprefix("file:").lstrip("/")

    assert out.count() == 3
    assert all(local(f).startswith(local(checkpoint_dir(spark))) for f in out.inputFiles())


def test_prepare_does_not_shuffle_the_table(spark, sf):
    from tabsift.plans.recipes import prepare
    from tabsift.plans.registry import DOC_SPEC
    from tabsift.sources.fixtures import document_features

    docs = document_features(load_table(spark, sf, "documents"))
    prepared = prepare(docs, DOC_SPEC, select_n=None, checkpoint=False)
    assert "RoundRobin" not in physical_plan(prepared.test)


def test_wide_profiles_stay_compiled(spark, sf):
    from tabsift.operators.profile import constant_columns, profile_columns
    from tabsift.plans.registry import _flows
    from tabsift.session import materialize

    flows = materialize(_flows(spark, sf))
    numbers = materialize(flows.select(*(F.col(f"`{c}`").try_cast("double").alias(c) for c in flows.columns)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (profile_columns(flows), profile_columns(numbers), constant_columns(numbers)):
            plan = physical_plan(df)
            lines = [x for x in plan.split("\n") if "HashAggregate" in x]
            assert lines and all("*(" in x for x in lines), lines[:2]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")

"""Delimited read/write and roundtrip checks."""

import pytest

from tabsift.session import scratch_path
from tabsift.sources.delimited import read_delimited, verify_roundtrip, write_delimited
from tabsift.sources.fixtures import load_table


def test_roundtrip_inferred_and_strings(spark, sf):
    part = load_table(spark, sf, "part")
    path = write_delimited(part, scratch_path(spark, "t-part"))
    inferred = read_delimited(spark, path)
    assert dict(inferred.dtypes)["p_retailprice"] == "double" and dict(inferred.dtypes)["p_size"] == "int"
    strings = read_delimited(spark, path, infer=False)
    assert set(dict(strings.dtypes).values()) == {"string"}
    assert inferred.count() == part.count()
    assert all(r["ok"] for r in verify_roundtrip(part, path).collect())


def test_explicit_schema_no_inference(spark, sf):
    cust = load_table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    path = write_delimited(cust, scratch_path(spark, "t-cust"))
    df = read_delimited(spark, path, schema="c_custkey long, c_acctbal double")
    assert df.dtypes == [("c_custkey", "bigint"), ("c_acctbal", "double")]


def test_single_column_falls_back_to_lines(spark, sf):
    path = write_delimited(load_table(spark, sf, "part").select("p_name"), scratch_path(spark, "t-lines"))
    with pytest.warns(UserWarning):
        df = read_delimited(spark, path)
    assert df.columns == ["value"]


def test_single_file_is_opt_in(spark, sf):
    import os

    part = load_table(spark, sf, "part").repartition(3)
    many = write_delimited(part, scratch_path(spark, "t-many"))
    one = write_delimited(part, scratch_path(spark, "t-one"), files=1)

    def parts(p):
        local = p.removeprefix("file:")
        return [f for f in os.listdir(local) if f.startswith("part-")]

    assert len(parts(one)) == 1 and len(parts(many)) >= 2


def test_roundtrip_detects_blank_line_loss(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "v string")
    path = write_delimited(df, scratch_path(spark, "t-blank"))
    checks = {r["check"]: r["ok"] for r in verify_roundtrip(df, path).collect()}
    assert checks["columns"] is True and checks["rows"] is False

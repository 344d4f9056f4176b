import hashlib

import pytest
from pyspark.sql import functions as F

from tabsift.llm.mixing import mix_sources, rake, text_kind, word_count


def mixed(docs, **kw):
    kw = {"margins": {"source": F.col("source"), "lang": F.col("lang"), "topic": text_kind(F.col("text"))}, "temperatures": {"source": 0.5, "lang": 0.7, "topic": 0.8}} | kw
    return mix_sources(docs, **kw)


def test_margins_meet_their_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixed(docs).collect()
    assert len(rows) == docs.count()
    whole = sum(r.n_tokens for r in rows)
    for margin, power in (("source", 0.5), ("lang", 0.7), ("topic", 0.8)):
        mass, share = {}, {}
        for r in rows:
            mass[r[margin]] = mass.get(r[margin], 0) + r.n_tokens
            share[r[margin]] = share.get(r[margin], 0) + r.n_tokens * r.factor / whole
        norm = sum(m**power for m in mass.values())
        assert all(abs(share[k] - mass[k] ** power / norm) < 2e-6 for k in mass)  # factors have 6 decimals


def test_sampling_follows_the_probability(spark, sf):
    for r in mixed(spark.read.parquet(f"{sf}/documents.parquet"), keep=0.6).collect():
        u = int(hashlib.md5(f"{r.doc_id}:42".encode()).hexdigest()[:13], 16) / 2**52
        assert r.kept == (u < r.probability) and abs(r.probability - min(1, 0.6 * r.factor)) < 1e-9
        assert abs(r.weight * r.probability - 0.6 * r.factor) < 1e-6


def test_given_targets(spark):
    cells = spark.createDataFrame([("a", "x", 30), ("a", "y", 10), ("b", "x", 20), ("b", "y", 40)], "s string, t string, tokens long")
    s = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "s string, target double")
    t = spark.createDataFrame([("x", 0.25), ("y", 0.75)], "t string, target double")
    got = {(r.s, r.t): r.tokens * r.factor for r in rake(cells, {"s": s, "t": t}).collect()}
    assert got[("a", "x")] + got[("a", "y")] == pytest.approx(50) and got[("a", "x")] + got[("b", "x")] == pytest.approx(25)
    assert got[("a", "x")] * got[("b", "y")] / (got[("a", "y")] * got[("b", "x")]) == pytest.approx(30 * 40 / (10 * 20))  # IPF keeps odds ratios


def test_sweeps_go_on_until_the_margins_are_met(spark):
    """Margins are met to nine digits; targets that no scaling can meet end with a warning."""
    cells = spark.createDataFrame([("a", "x", 1000), ("a", "y", 250), ("b", "x", 250), ("b", "y", 1000)], "s string, t string, tokens long")
    s = spark.createDataFrame([("a", 0.7), ("b", 0.3)], "s string, target double")
    t = spark.createDataFrame([("x", 0.4), ("y", 0.6)], "t string, target double")
    got = {(r.s, r.t): r.tokens * r.factor / 2500 for r in rake(cells, {"s": s, "t": t}).collect()}
    assert got["a", "x"] + got["a", "y"] == pytest.approx(0.7, abs=1e-9) and got["a", "x"] + got["b", "x"] == pytest.approx(0.4, abs=1e-9)
    with pytest.warns(UserWarning, match="contradict"):
        rake(cells.where("s = 'a' and t = 'x' or s = 'b' and t = 'y'"), {"s": s, "t": t})


def test_awkward_rows(odd, empty):
    rows = mixed(odd, with_row=True).collect()
    assert len(rows) == odd.count()
    assert {r.source for r in rows if r.doc_id == 4} == {"(none)"} and all(r.row.cell == "clash" and r.row.tokens == "clash" for r in rows)
    assert {r.kept for r in rows if r.doc_id in (1, 2, 3)} <= {True, False}
    assert mixed(empty).count() == 0


def test_words(spark):
    df = spark.createDataFrame([(None,), ("",), (" a\tb\n c ",)], "t string")
    assert [r[0] for r in df.select(word_count(F.col("t"))).collect()] == [0, 0, 3]


def test_plans_run_no_python(spark, sf):
    from tabsift.llm.queries import op7_mixing, op10_line_dedup

    for q in (op7_mixing, op10_line_dedup):
        plan = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan

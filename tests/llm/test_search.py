import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsift.llm.lexical import Automaton, Best, count_terms, fold_text, lexical_search
from tests.llm import brute

import numpy as np


def answer(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def items_of(spark, sf):
    return spark.read.parquet(f"{sf}/benchmark.parquet")


@pytest.mark.parametrize("size", [2_000_000, 3_000])
def test_equals_brute_force(spark, sf, size):
    """One automaton, and many blocks of items."""
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), items_of(spark, sf)
    rows = lambda df, *c: [tuple(r) for r in df.select(*c).collect()]
    want = brute.search(rows(docs, "doc_id", "text"), rows(items, "item_id", "text"))
    assert answer(lexical_search(docs, items, automaton_bytes=size)) == sorted(want, key=repr)


def test_awkward_rows(spark, odder, empty):
    items = spark.createDataFrame(
        [(1, "same TEXT twice"), (2, "日本語のテキスト 12345"), (3, None), (4, " -- "), (5, "nowhere-to be_found"), (1, "word"), (None, "Passage word"), (6, "z" * 20000)],
        "item_id long, text string",
    )
    docs = [tuple(r) for r in odder.select("doc_id", "text").collect()]
    rows = [tuple(r) for r in items.collect()]
    for k in (50, 3):
        assert answer(lexical_search(odder, items, k=k)) == sorted(brute.search(docs, rows, k), key=repr)
    assert lexical_search(empty, items).count() == 0 and lexical_search(odder, items.where("false")).count() == 0
    clash = items.withColumn("rank", F.lit("x")).withColumn("terms", F.lit("y")).withColumn("block", F.lit("z"))
    assert answer(lexical_search(odder, clash)) == sorted(brute.search(docs, rows), key=repr)


def test_one_document_a_third_of_all(spark):
    docs = spark.range(900).selectExpr("id doc_id", "case when id % 3 = 0 then 'the hot one' else concat('the item ', id % 7, ' of many') end text")
    items = spark.createDataFrame([(1, "the hot item"), (2, "many 3")], "item_id int, text string")
    want = brute.search([tuple(r) for r in docs.collect()], [(1, "the hot item"), (2, "many 3")])
    assert answer(lexical_search(docs, items, salts=4)) == sorted(want, key=repr)


def test_very_long_text(spark):
    text = "needle " + "hay stack " * 600_000 + "needle"
    docs = spark.createDataFrame([(1, text), (2, "needle in hay")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "needle")], "item_id long, text string")
    assert answer(lexical_search(docs, items)) == sorted(brute.search([(1, text), (2, "needle in hay")], [(1, "needle")]), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aAbB1 -_.éß日😀\x00\x7f\t", max_size=60), st.lists(st.text(alphabet="ab1éß日😀", min_size=1, max_size=3), max_size=6, unique=True))
def test_automaton_counts_whole_terms(text, terms):
    found = brute.WORD.findall(brute.fold(text))
    assert count_terms(fold_text(text)) == len(found)
    term, tf = Automaton(terms).count(fold_text(text))
    assert {terms[t]: n for t, n in zip(term.tolist(), tf.tolist())} == {t: found.count(t) for t in terms if t in found}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5), st.integers(0, 4)), max_size=60), st.integers(1, 4))
def test_best_keeps_the_best(rows, k):
    best, want = Best(3, k), []
    for item, doc, score in rows:
        scores = np.zeros((1, 3), np.int64)
        scores[0, item] = score
        best.add(0, np.array([doc]), scores)
        if doc % 2:
            best.settle()
    for item in range(3):
        want += [(item, d, s) for s, d in sorted(((s, d) for i, d, s in rows if i == item and s), key=lambda x: (-x[0], x[1]))[:k]]
    assert list(map(tuple, best.settle().T.tolist())) == want

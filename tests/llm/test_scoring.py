import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsift.llm import interpolation as I
from tests.llm import brute


def number(i):
    return None if i is None else zlib.crc32(str(i).encode())


def conditions():
    n = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return n % 7 != 2, F.floor(n / 7) % I.DELETED == 0


def plain(rows, order):
    """(doc_id, tokens, known, training tokens, base, score) by definition, and the model."""
    training = [(i, t) for i, t in rows if i is not None and number(i) % 7 != 2]
    left_out = [t for i, t in training if number(i) // 7 % I.DELETED == 0]
    model = brute.Interpolation([t for i, t in training if number(i) // 7 % I.DELETED], left_out, order, I.TOLERANCE, I.ROUNDS)
    model.learn([t for _, t in training])
    out = []
    for i, t in rows:
        grams = model.grams(t)
        own = [model.counts[g[-1:]] for g in grams]
        base = sum(math.log10((c + 1) / (model.n + model.v + 1)) for c in own)
        out.append((i, len(grams), sum(c > 0 for c in own), model.n, base, sum(math.log10(model.chance(g)) for g in grams)))
    return out, model


def same(got, want):
    order = lambda rows: sorted(rows, key=lambda r: (repr(r[:4]), r[4]))
    got, want = order(got), order(want)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    np.testing.assert_allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-7)


COLUMNS = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


@pytest.mark.parametrize("order,slice_bytes,range_bytes", [(2, 16_000_000, 8_000_000), (2, 20_000, 10_000), (3, 60_000, 50_000), (1, 100_000, 100_000)])
def test_equals_brute_force(spark, sf, order, slice_bytes, range_bytes):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = I.score_texts(docs, *conditions(), order=order, slice_bytes=slice_bytes, range_bytes=range_bytes).select(*COLUMNS).collect()
    same(list(map(tuple, got)), plain([tuple(r) for r in docs.select("doc_id", "text").collect()], order)[0])


def test_awkward_rows(spark, odder, empty):
    rows = [tuple(r) for r in odder.select("doc_id", "text").collect()]
    got = I.score_texts(odder, *conditions(), slice_bytes=30_000).select(*COLUMNS).collect()
    same(list(map(tuple, got)), plain(rows, 2)[0])
    assert I.score_texts(empty, *conditions()).count() == 0
    untrained = I.score_texts(odder, F.lit(None).cast("boolean"), F.lit(True)).collect()
    assert len(untrained) == len(rows) and all(r.score == r.base_score == 0 and r.train_tokens == r.n_known == 0 for r in untrained)


def test_held_out_texts_and_distribution(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    scored, model = plain(rows, 2)
    held = [r for r in scored if number(r[0]) % 7 == 2]
    assert sum(r[5] for r in held) > sum(r[4] for r in held) and all(r[5] < 0 for r in scored)
    words = [g for g in model.counts if len(g) == 1 and g != ("<s>",)]
    for context in ["<s>", words[0][0], words[7][0], ("never seen",)]:
        total = sum(model.chance((context, w[0])) for w in words) + model.chance((context, ("never seen either",)))
        assert total == pytest.approx(1)


def test_query(spark, sf):
    from tabsift.llm.queries import op12_lm_scoring

    got = op12_lm_scoring(spark, sf)
    assert got.columns[:2] == ["doc_id", "held_out"]
    assert all(r.held_out == (number(r.doc_id) % 7 == 2) for r in got.collect())


def test_very_long_text(spark):
    rows = [(1, "some words that come again " * 250_000), (2, "some words"), (3, "x" * 3_000_000 + " y"), (4, "again that word")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = I.score_texts(docs, *conditions(), slice_bytes=1_000_000).select(*COLUMNS).collect()
    same(list(map(tuple, got)), plain(rows, 2)[0])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aAbé \t\n\x85\x1c日", max_size=30), min_size=1, max_size=6), st.integers(1, 3), st.integers(1, 20))
def test_tokens(texts, order, portion):
    I.PORTION, kept = portion, I.PORTION
    try:
        found, start = I.token_hashes([t.encode() for t in texts], order)
    finally:
        I.PORTION = kept
    words = [brute.tokens(t) for t in texts]
    assert start.tolist() == np.cumsum([0, *(len(w) + order - 1 for w in words)])[:-1].tolist()
    name = {}
    for t, s in zip(words, start):
        own = found[s : s + len(t) + order - 1].tolist()
        for w, x in zip(["<s>"] * (order - 1) + [(w,) for w in t], own):
            assert name.setdefault(w, x) == x
    assert len(set(name.values())) == len(name)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50, unique=True), st.integers(1, 9))
def test_packing(values, ranges):
    keys = np.sort(np.array(values, np.uint64))
    assert (I.unpack_keys(I.pack_keys(keys)) == keys).all()
    bounds = I.range_bounds(keys, ranges)
    assert bounds[-1] == len(keys) and all(int(k) * ranges >> 64 == r for r, (a, z) in enumerate(zip(bounds, bounds[1:])) for k in keys[a:z])

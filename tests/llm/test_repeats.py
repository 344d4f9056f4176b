import hashlib
import pathlib
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import tabsift.llm.repeats as R
from tabsift.llm.repeats import RunIndex, anchors, remove_repeats, scan_bucket, suffix_array
from tests.llm import brute

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def run(docs, **kw):
    return sorted(map(tuple, remove_repeats(docs, **kw).select(*COLUMNS).collect()))


def test_matches_brute_force_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert run(docs) == brute.repeats([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_matches_brute_force_on_awkward_rows(odd):
    assert run(odd) == brute.repeats([tuple(r) for r in odd.select("doc_id", "text").collect()])


def test_owners_dealt_over_several_buckets(spark, sf, odd, monkeypatch):
    monkeypatch.setattr(R, "BUCKET_ANCHORS", 3)
    monkeypatch.setattr(R, "BLOCK_BITS", 8)
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60").select("doc_id", "text").unionByName(
        odd.selectExpr("doc_id + 1000000 doc_id", "text")
    )
    assert run(docs) == brute.repeats([tuple(r) for r in docs.collect()])


def test_kept_bytes_and_spans(odd):
    for r in remove_repeats(odd, with_kept=True).collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        assert len(r.kept) == r.n_bytes - r.n_removed == r.n_bytes - sum(s.last - s.first for s in r.spans)


def test_null_ids_and_empty_table(spark, empty):
    body = "".join(chr(97 + k * k % 23) for k in range(400))
    df = spark.createDataFrame([(None, body), (5, body + "!"), (None, "short")], "doc_id long, text string")
    got = {(r.doc_id, r.n_bytes): r.n_removed for r in remove_repeats(df).collect()}
    assert got == {(None, 400): 400, (5, 401): 400, (None, 5): 0}
    assert remove_repeats(empty).count() == 0


def shuffle_files(spark):
    """The shuffle files that the session has on disk, with their bytes."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f: f.stat().st_size for d in dirs for f in pathlib.Path(d.getPath()).rglob("shuffle_*.data")}


def test_only_texts_with_something_shared_are_moved(spark, tmp_path):
    """Joins of whole texts are told beforehand which of them can match; the others write nothing to disk."""
    rng = np.random.default_rng(31)
    word = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    shared = word(300)
    texts = [word(10_000) for _ in range(200)] + [f"A{shared}B", f"C{word(900)}D{shared}E"] + [word(250) + "!"] * 2
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large to be broadcast
    try:
        before = shuffle_files(spark)
        got = {r[0]: r[2] for r in run(docs)}
        moved = sum(size for file, size in shuffle_files(spark).items() if file not in before)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {i: 0 for i in range(200)} | {200: 300, 201: 300, 202: 251, 203: 251}
    assert moved < 1_500_000  # of 2 MB of texts; the last join alone left 2 MB on disk when it moved them all


def test_rows_are_marked_by_the_filter(spark):
    from tabsift.llm.common import mark_maybe_in

    rows = spark.createDataFrame([(i, str(i)) for i in [None, *range(2000)]] + [(7, "again")], "doc_id long, text string")
    keys = rows.where("doc_id % 100 = 7").select("doc_id")
    out = mark_maybe_in(rows, keys, "doc_id", "told").collect()
    assert sorted(r.text for r in out) == sorted(r.text for r in rows.collect())
    told = [r.doc_id for r in out if r.told]
    assert None not in told and len(told) < 50 and told.count(7) == 2 and {r.doc_id for r in keys.collect()} <= set(told)
    assert not any(r.told for r in mark_maybe_in(rows, keys.limit(0), "doc_id", "told").collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=40), min_size=1, max_size=6), st.integers(2, 12))
def test_index_finds_all_repeats(texts, length):
    pieces = [t.encode() for t in texts]
    _, offsets, repeated, listed = scan_bucket(pieces, length)
    places = [(i, s) for i, p in enumerate(pieces) for s in range(len(p) - length + 1)]
    grams = [pieces[i][s : s + length] for i, s in places]
    assert [bool(repeated[offsets[i] + s]) for i, s in places] == [grams.count(g) > 1 for g in grams]
    assert sorted(pieces[i][s : s + length] for i, s in places if listed[offsets[i] + s]) == sorted(set(grams))


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=200))
def test_suffix_array(data):
    data = bytes(b | 1 for b in data)
    sa, *_ = suffix_array(np.frombuffer(data, np.uint8))
    assert sa.tolist() == sorted(range(len(data)), key=lambda k: data[k:])


@pytest.mark.parametrize("period", [1, 13, 500, 4099])
def test_long_matches_of_periodic_text_are_found_quickly(period):
    """A statistic on periodic text is nearly the length of the text; it is found in steps of its logarithm."""
    text = np.tile(np.random.default_rng(period).integers(97, 123, period).astype(np.uint8), 500_000 // period)
    start = time.process_time()
    up, down = RunIndex(text).matching_statistics()
    assert time.process_time() - start < 5  # 10 s and more when matches are walked along
    at = np.arange(len(text))
    assert (np.maximum(up, down) == len(text) - at - np.where(at < period, period, 0)).all()


def test_runs_are_few_on_repetitive_text():
    body = np.random.default_rng(2).integers(97, 123, 2000).astype(np.uint8).tobytes()
    index = RunIndex(np.frombuffer(body * 20, np.uint8))
    assert len(index.run_bytes) < 2500 and index.run_lengths.sum() == 40000


@pytest.mark.parametrize("length,width", [(200, 64), (50, 20)])
def test_equal_strings_have_equal_anchors(length, width, monkeypatch):
    monkeypatch.setattr(R, "BATCH_CHARS", 700)
    rng = np.random.default_rng(9)
    shared = rng.integers(97, 123, length).astype(np.uint8).tobytes()
    a = rng.integers(97, 123, 900).astype(np.uint8).tobytes() + shared + b"x" * 100
    b = b"yy" + shared + rng.integers(97, 123, 2500).astype(np.uint8).tobytes()
    at_a, at_b = anchors(a, length, width)[0], anchors(b, length, width)[0]
    rel = lambda at, s: {int(p) - s for p in at if s <= p <= s + length - width}
    assert rel(at_a, 900) & rel(at_b, 2)

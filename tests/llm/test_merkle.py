import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsift.llm.merkle import OpenTree, fold, merkle_manifest
from tests.llm import brute

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def answer(spark, docs, tmp, **kw):
    from tabsift.llm import queries

    path = str(tmp / "documents.parquet")
    docs.write.parquet(path)
    return sorted(map(tuple, queries.op13_merkle_manifest(spark, str(tmp)).collect()), key=repr)


def test_query_equals_brute_force(spark, odder, tmp_path):
    rows = [tuple(r) for r in odder.select(*FIELDS).collect()]
    assert answer(spark, odder, tmp_path) == sorted(brute.manifest(rows), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_blocks_and_rounds(spark, sf, levels):
    """Small blocks need several rounds of block roots; the witnesses are the same."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = merkle_manifest(docs, FIELDS, levels=levels)
    got = got.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256), fold(F.col("leaf"), F.col("sides"), F.col("siblings")))
    want = [(*r[:5], r[3]) for r in brute.manifest([tuple(r) for r in docs.select(*FIELDS).collect()])]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_one_group_one_row_and_none(spark, odd, empty):
    for n in (0, 1, 2):
        docs = odd.where(F.col("doc_id").isin(1, 4)).limit(n) if n < 2 else odd.where(F.col("doc_id").isin(4, 7))
        got = [(r.doc_id, r.leaf, r.subroot, r.root) for r in merkle_manifest(docs, FIELDS).collect()]
        assert sorted(got) == sorted(r[:4] for r in brute.manifest([tuple(r) for r in docs.select(*FIELDS).collect()]))
    assert merkle_manifest(empty, FIELDS).count() == 0


def test_third_of_all_rows_alike(spark):
    docs = spark.range(600).selectExpr("case when id % 3 = 0 then 7 else id end doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) text", "'en' lang", "'s' source", "4L n_chars")
    got = merkle_manifest(docs, FIELDS, levels=3)
    placed = sorted(r.position for r in got.collect())
    assert placed == list(range(600))
    folded = got.select((fold(F.col("leaf"), F.col("sides"), F.col("siblings")) == F.col("root")).alias("ok")).distinct().collect()
    assert [r.ok for r in folded] == [True]


def test_very_long_text(spark):
    rows = [(1, "s", "en", 5, "ä" * 5_000_000), (2, "s", "en", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = sorted((r.doc_id, r.leaf, r.root) for r in merkle_manifest(docs, FIELDS).collect())
    assert got == sorted((r[0], r[1], r[3]) for r in brute.manifest(rows))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.integers(0, 4))
def test_open_tree(n, cut):
    """Appending in aligned blocks of 2 ** cut and then their roots gives the witnesses of the whole tree."""
    leaves = [brute.h(str(i)) for i in range(n)]
    root, paths = brute.merkle_paths(leaves)
    blocks, upper = [], OpenTree()
    for a in range(0, n, 1 << cut):
        tree = OpenTree()
        for d in leaves[a : a + (1 << cut)]:
            tree.append(d)
        upper.append(tree.close(cut if n > 1 << cut else 0))
        blocks.append(tree)
    assert upper.close() == root
    assert [s + upper.steps[b] for b, t in enumerate(blocks) for s in t.steps] == paths

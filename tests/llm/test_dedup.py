import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsift.llm.components import connected_components
from tabsift.llm.exact_dedup import clashing_tags, exact_dedup
from tabsift.llm.line_dedup import host_of, html_lines, line_dedup
from tabsift.llm.rolling import chunk_ends, window_hashes
from tabsift.llm.simhash import anchors_of, near_links, simhash_dedup, syndrome_masks
from tests.llm import brute
from tests.llm.conftest import rows_of


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["sf", "odd"])
def test_exact_dedup_matches_brute_force(spark, sf, odd, which):
    docs = odd if which == "odd" else spark.read.parquet(f"{sf}/documents.parquet")
    got = exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == brute.exact(pairs(docs))


def test_exact_dedup_empty(empty):
    assert exact_dedup(empty).count() == 0


def test_colliding_tags_are_seen(spark):
    df = spark.createDataFrame([([1, 2], [b"a", b"b"]), ([1], [b"c"]), ([2], [b"b"])], "tags array<long>, proofs array<binary>")
    assert [r.tag for r in clashing_tags(df).collect()] == [1]


def test_chunks_cover_text_and_follow_content():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 123, 60000).astype(np.uint8).tobytes()
    ends = chunk_ends(body, 2048, 512, 16384)
    assert ends[-1] == len(body) and sorted(set(ends)) == ends
    shifted = chunk_ends(b"some other beginning " + body, 2048, 512, 16384)
    assert len(set(ends) & {e - 21 for e in shifted}) > len(ends) // 2
    text = ("é" * 50000).encode()
    assert all((text[e : e + 1] or b"a")[0] & 0xC0 != 0x80 for e in chunk_ends(text, 64, 16, 101))
    assert chunk_ends(b"", 64, 16, 100) == []


def test_window_hashes_depend_on_the_window_only():
    buf = np.frombuffer(b"abcabcabcabc" * 30, np.uint8)
    for width in (1, 3, 32, 64, 200):
        h = window_hashes(buf, width)
        assert len(h) == len(buf) - width + 1 and (h[:-3] == h[3:]).all() and len(set(h[:3].tolist())) == 3


@pytest.mark.parametrize("which", ["sf", "odd"])
def test_simhash_matches_brute_force(spark, sf, odd, which):
    docs = odd if which == "odd" else spark.read.parquet(f"{sf}/documents.parquet")
    got = simhash_dedup(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == brute.simhash(pairs(docs))


def test_simhash_empty(empty):
    assert simhash_dedup(empty).count() == 0


def test_every_near_pair_shares_an_anchor():
    rng = np.random.default_rng(7)
    masks = syndrome_masks(2)
    assert {len(m) for m in masks} == {1, 32}
    x = rng.integers(-(2**63), 2**63, 300, dtype=np.int64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 3), replace=False)) for _ in x], np.uint64)
    y = (x.view(np.uint64) ^ flips).view(np.int64)
    for p, q in zip(anchors_of(x, masks), anchors_of(y, masks)):
        assert set(p.tolist()) & set(q.tolist())


def test_near_links_connect_exactly_the_near_ones(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**62, 40)
    fps = {int(b) for b in base}
    for b in base[:20]:
        for _ in range(6):
            fps.add(int(b) ^ sum(1 << int(k) for k in rng.choice(63, rng.integers(1, 5), replace=False)))
    fps = sorted(fps)
    want = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if bin(a ^ b).count("1") <= 2]
    got = [tuple(r) for r in near_links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()]
    assert all(bin(a ^ b).count("1") <= 2 for a, b in got)
    assert brute.components(fps, got) == brute.components(fps, want)


def test_components(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (220, 2))] + [(k, k + 1) for k in range(1000, 1100)] + [(7, 7)]
    links += [(5000, k) for k in range(5001, 5200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute.components({x for p in links for x in p if p[0] != p[1]}, links)
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("ratio", [0.1, 0.4])
def test_line_dedup_matches_brute_force(spark, sf, odd, ratio):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd):
        rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
        got = line_dedup(docs, "doc_id", F.col("source"), F.col("text"), ratio, 2).select("page", "text").collect()
        assert sorted(map(tuple, got), key=repr) == brute.lines(rows, ratio, 2)


def test_line_dedup_drops_lines_of_the_site_only(spark):
    rows = [(i, "a" if i < 6 else "b", f"menu\nown {i}\nmenu \n\nend" if i != 9 else "menu") for i in range(12)]
    df = spark.createDataFrame([*rows, (12, "b", "all mine")], "doc_id long, source string, text string")
    got = {r.page: (r.text, r.n_dropped) for r in line_dedup(df, "doc_id", F.col("source"), F.col("text"), 0.9, 3).collect()}
    assert got[0] == ("own 0\n", 3) and got[7] == ("menu\nown 7\nmenu \n\nend", 0)
    assert got[12] == ("all mine", 0)


def test_line_dedup_empty(empty):
    assert line_dedup(empty, "doc_id", F.col("source"), F.col("text")).count() == 0


def test_hosts_and_html(spark):
    df = spark.createDataFrame(
        [("https://user@A.Example.com:80/x?y#z", "<p>one</p><p>two<br>three</p><script>var x='<p>';</script>"), ("nothing", None), (None, "plain")],
        "u string, h string",
    )
    got = [tuple(r) for r in df.select(host_of(F.col("u")), html_lines(F.col("h"))).collect()]
    assert [g[0] for g in got] == ["a.example.com", None, None]
    assert got[0][1].split() == ["one", "two", "three"] and got[1][1] is None and got[2][1] == "plain"


def test_queries_read_the_tables(spark, sf):
    from tabsift.llm.queries import op3_exact_dedup, op4_simhash

    rows = rows_of(spark, sf)
    assert op3_exact_dedup(spark, sf).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, op4_simhash(spark, sf).collect())) == brute.simhash(rows)

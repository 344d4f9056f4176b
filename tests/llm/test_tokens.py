import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import tabsift.llm.bpe as B
from tabsift.llm.bpe import coder, encode_texts
from tabsift.llm.packing import FreeSpace, best_fit_decreasing, pack_tokens


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(B.default_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("which", ["sf", "odd"])
def test_equals_the_library(spark, sf, odd, library, which):
    docs = odd if which == "odd" else spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = []
    for i, t in rows:
        ids = ids_of(library, t)
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, encode_texts(docs, outputs=()).select(*columns).collect())) == sorted(want)
    if which == "odd":
        full = encode_texts(docs).collect()
        assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in full) == sorted(want)
        assert all(hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 for r in full)
        assert sorted(r.decoded for r in full) == sorted(t or "" for _, t in rows)


def test_empty_table(empty):
    assert encode_texts(empty, outputs=()).count() == 0
    assert pack_tokens(empty).count() == 0


PARTS = st.sampled_from(
    ["the", " the", "  ", " ", "\n", "\n ", "\t", "don't", "'s", "'", "123", " 4", "!?", "<|endoftext|>", "<|", "é", " ü", "日本", " ", "　 ", "😀", "\x1c ", "\x85 x", "word" * 9]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=40), st.lists(st.integers(0, 200), max_size=6))
def test_joined_chunks_equal_the_whole(library, parts, cuts):
    text = "".join(parts)
    tool = coder()
    want = ids_of(library, text)
    assert tool.encode(text).tolist() == want
    edges = sorted({0, len(text), *(c for c in cuts if c < len(text))})
    chunks = [tool.encode_chunk(text[a:b]) for a, b in zip(edges, edges[1:])]
    assert tool.join(chunks).tolist() == want
    assert tool.decode(np.array(want, "<u4")) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(library, text):
    assert coder().encode(text).tolist() == ids_of(library, text)


def test_letters_below_the_fast_limit_agree(library):
    text = " ".join(f"a{chr(c)}b {chr(c)}" for c in range(1, 0x250))
    assert coder().fast.encode_ordinary(text) == ids_of(library, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=60))
def test_best_fit_decreasing(lengths):
    bins = best_fit_decreasing(lengths, 50)
    assert sorted(i for b in bins for i in b) == [i for i, n in enumerate(lengths) if n]
    free, plain = [], []
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        if not lengths[i]:
            continue
        fits = [k for k, f in enumerate(free) if f >= lengths[i]]
        if not fits:
            free.append(50)
            plain.append([])
            fits = [len(free) - 1]
        k = min(fits, key=lambda k: free[k])
        free[k] -= lengths[i]
        plain[k].append(i)
    assert sorted(sum(lengths[i] for i in b) for b in bins) == sorted(sum(lengths[i] for i in b) for b in plain)


def test_free_space():
    f = FreeSpace(10)
    assert f.take(1) is None
    for free, which in ((3, 0), (7, 1), (7, 2)):
        f.add(free, which)
    assert f.take(4) == (7, 2) and f.take(4) == (7, 1) and f.take(4) is None and f.take(3) == (3, 0)


@pytest.mark.parametrize("which", ["sf", "odd"])
def test_packing_round_trip(spark, sf, odd, library, which):
    docs = odd if which == "odd" else spark.read.parquet(f"{sf}/documents.parquet")
    rows = pack_tokens(docs, capacity=512, block_chars=100_000).collect()
    assert len({r.pack_id for r in rows}) == len(rows)
    pieces = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == 512 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 512
        assert r.position_resets == r.cu_seqlens[:-1] and len(r.doc_ids) == r.n_segments
        assert (ids[r.n_tokens :] == 50256).all()
        for d, s, a, b in zip(r.doc_ids, r.piece_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            pieces[d].append((s, ids[a:b].tolist()))
    texts = defaultdict(list)
    for r in docs.collect():
        if r.text:
            texts[r.doc_id].append(ids_of(library, r.text))
    assert set(pieces) == set(texts)
    for d, want in texts.items():
        got = sorted(pieces[d])
        assert sum(len(p) for _, p in got) == sum(map(len, want))
        if len(want) == 1:
            assert [x for _, p in got for x in p] == want[0]
    full = sum(r.n_tokens for r in rows) / (512 * len(rows))
    assert which == "odd" or full > 0.95

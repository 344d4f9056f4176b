import hashlib

import numpy as np
import pytest

import corpus_pipeline as P
from tabsift.llm.bpe import coder
from tabsift.llm.queries import ORACLE_SQL, QUERIES, mixture
from tests.llm import brute


@pytest.fixture(scope="module")
def written(spark, sf, tmp_path_factory):
    out, docs = [], spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_stages_against_brute_force(spark, sf, written):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lang, lines, near, mixed, tokens = written
    assert all(d.columns == docs.columns and d.dtypes == docs.dtypes for d in (lang, lines, near, mixed))
    has_letter = [r for r in rows(docs, "doc_id", "text") if any(c.isalpha() for c in r[1] or "")]
    assert rows(lang, "doc_id", "text") == has_letter
    assert rows(lines, "doc_id", "text") == brute.lines([tuple(r) for r in lang.select("doc_id", "source", "text").collect()], 0.1, 3)
    assert all(r[0] == len(r[1]) for r in rows(lines, "n_chars", "text"))
    groups = brute.simhash(rows(lines, "doc_id", "text"))
    assert rows(near, "doc_id") == sorted([(i,) for i, _, c in groups if i == c], key=repr)
    assert rows(mixed, *docs.columns) == rows(mixture(near, with_row=True).where("kept").select("row.*"), *docs.columns)
    want = []
    for i, t in rows(mixed, "doc_id", "text"):
        ids = np.array(coder().library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), bytearray(ids)))
    assert rows(tokens, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids") == sorted(want, key=repr)
    assert 0.5 * docs.count() < mixed.count() <= near.count()


def test_awkward_and_empty_documents(spark, sf, odd, empty):
    for docs, n in ((odd, odd.count()), (empty, 0)):
        for _, stage in P.STAGES[:-1]:
            docs = P.materialize(stage(spark, docs, sf))
            assert docs.columns == odd.columns and docs.count() <= n
        last = P.STAGES[-1][1](spark, docs, sf)
        assert last.count() == docs.count()


def test_oracles_match(spark):
    from tests.oracle_compare import duck

    import pandas as pd

    sf = "/root/testdata/sf0.001"
    con = duck(sf)
    for name, sql in ORACLE_SQL.items():
        got = QUERIES[name](spark, sf).toPandas()
        want = con.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns), name
        key = list(got.columns)[:2]
        got, want = (d[sorted(d.columns)].sort_values(key).reset_index(drop=True) for d in (got, want))
        pd.testing.assert_frame_equal(got, want, check_dtype=False, obj=name)


DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", source, len(t)) for i, t, source in texts], DOC)


def prose(seed, n=60):
    return " ".join(np.random.default_rng(seed).choice([f"{a}{b}{c}" for a in "bdfglm" for b in "aeiou" for c in "nrst"], n))


def test_copies_keep_their_text(spark, sf):
    """Two groups of copies in one source, and a line that stands on other pages: one whole text of each group survives."""
    own = [(i, prose(i) + "\nsubscribe to our letter", "s") for i in range(20)]
    copies = [(100 + i, prose(900), "s") for i in range(12)] + [(200 + i, prose(901) + "\n" + prose(902), "s") for i in range(6)]
    lines = P.materialize(P.drop_site_lines(spark, documents(spark, own + copies), sf))
    texts = {r.doc_id: r.text for r in lines.collect()}
    assert all(texts[i] == t for i, t, _ in copies) and all(texts[i] == prose(i) for i, _, _ in own)
    near = {r.doc_id: r.text for r in P.near_dedup(spark, lines, sf).collect()}
    assert near[100] == copies[0][1] and near[200] == copies[12][1] and len(near) == 22


def test_null_and_repeated_ids_keep_their_documents(spark, sf):
    """Each group of one text keeps one row whatever its ids are."""
    rows = [(None, prose(k), "s") for k in (1, 2, 3, 3)] + [(7, prose(4), "s"), (7, prose(5), "s"), (7, prose(5), "s"), (None, prose(6), "s"), (9, prose(6), "s"), (8, prose(6), "s")]
    got = [(r.doc_id, r.text) for r in P.near_dedup(spark, documents(spark, rows), sf).collect()]
    assert sorted(got, key=repr) == sorted([(None, prose(k)) for k in (1, 2, 3)] + [(7, prose(4)), (7, prose(5)), (8, prose(6))], key=repr)


def test_kept_tokens_have_the_target_shares(spark, sf):
    """20 sources of which one holds a third: what the stage keeps has the shares of the square roots."""
    hot = "case when id % 3 = 0 then 's0' else concat('s', 1 + id % 19) end"
    docs = spark.range(6000).selectExpr("id doc_id", "concat(repeat('word ', 20), id) text", "'en' lang", f"{hot} source", "20L n_chars")
    counts = {r[0]: r[1] for r in docs.groupBy("source").count().collect()}
    kept = {r[0]: r[1] for r in P.mix(spark, docs, sf).groupBy("source").count().collect()}
    norm = sum(n**0.5 for n in counts.values())
    assert len(kept) == 20 and all(abs(kept[k] / sum(kept.values()) - n**0.5 / norm) < 0.012 for k, n in counts.items())

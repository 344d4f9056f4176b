import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsift.llm.langid import LanguageModel, fit_language_model, identify, label_spans, viterbi
from tabsift.llm.queries import op2_language_id, op6_toxicity
from tabsift.llm.toxicity import BINS, SYMBOLS, ToxicityModel, decode, fit_toxicity, lattice, restored_words, toxicity
from tests.llm import brute


def plain_viterbi(scores, starts, penalty):
    n, k = scores.shape
    best, back = np.zeros(k), []
    for t in range(n):
        cost = 0.0 if t in starts else penalty
        step = best[:, None] - np.where(np.eye(k, dtype=bool), 0, cost)
        back.append(step.argmax(0))
        best = step.max(0) + scores[t]
    path = [int(best.argmax())]
    for t in range(n - 1, 0, -1):
        path.append(int(back[t][path[-1]]))
    return np.array(path[::-1], int) if n else np.zeros(0, int)


def total(scores, starts, penalty, path):
    changes = [t for t in range(1, len(path)) if path[t] != path[t - 1] and t not in starts]
    return scores[np.arange(len(path)), path].sum() - penalty * len(changes)


@pytest.mark.parametrize("n", [1, 5, 256, 257, 1500])
def test_lanes_give_a_best_path(n):
    rng = np.random.default_rng(n)
    for k in (1, 2, 4):
        scores = rng.normal(size=(n, k)) * 3
        starts = np.unique(np.append(0, rng.integers(0, n, 4)))
        got, want = viterbi(scores, starts, 2.5), plain_viterbi(scores, set(starts.tolist()), 2.5)
        assert np.isclose(total(scores, set(starts.tolist()), 2.5, got), total(scores, set(starts.tolist()), 2.5, want))


@pytest.fixture(scope="module")
def model(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return fit_language_model(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))


def test_held_out_accuracy(spark, sf):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_language_id(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == brute.held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) / len(held) > 0.97


def test_spans_of_mixed_text(spark, sf, model):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("n_chars between 1500 and 6000").collect()
    en = next(r.text for r in docs if r.lang == "en" and " | " not in r.text)
    fr = next(r.text for r in docs if r.lang == "fr" and " | " not in r.text)
    (spans,) = label_spans([en + "\n" + fr], model)
    names = [model.langs[s[2]] for s in spans]
    assert "en" in names and "fr" in names and len(spans) <= 6
    edge = len(en)
    right = sum(min(b, edge) - a for a, b, k, _ in spans if model.langs[k] == "en" and a < edge)
    assert right > 0.9 * edge


def test_scripts_narrow_candidates(spark):
    rows = [(1, "abc def ghi " * 30, "xx"), (2, "абв где жзи " * 30, "yy")]
    m = fit_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    spans = label_spans(["qqq www eee абя ююю", "漢字"], m)
    assert [m.langs[s[2]] for s in spans[0]] == ["xx", "yy"] and len(spans[1]) == 1


def test_identify_awkward_rows(odd, empty, model):
    rows = identify(odd, model).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in odd.collect())
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0.0 and not by[i].spans for i in (1, 2, 3, 5))
    assert by[10].lang_pred in model.langs and identify(empty, model).count() == 0
    none = fit_language_model(odd.where("false"))
    assert {r.lang_pred for r in identify(odd, none).collect()} == {"und"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=6))
def test_spans_are_sound(texts):
    rng = np.random.default_rng(0)
    from tabsift.llm.langid import BUCKETS
    from tabsift.llm.unicode_tables import SCRIPTS

    m = LanguageModel(["a", "b"], rng.normal(size=(2, BUCKETS)).astype(np.float32), np.ones((len(SCRIPTS), 2), bool))
    for text, spans in zip(texts, label_spans(texts, m)):
        assert sum(s[3] for s in spans) == sum(c.isalpha() for c in text)
        assert all(text[a].isalpha() and text[b - 1].isalpha() for a, b, _, _ in spans)


# --- toxicity -----------------------------------------------------------------------------------------------

BAD = ["idiot", "trash", "worthless", "moron", "scum"]
GOOD = "the river was calm and green while birds sang over quiet fields near town".split()


@pytest.fixture(scope="module")
def toxic_model(spark):
    rng = np.random.default_rng(3)
    rows, marks = [], []
    for i in range(600):
        words = list(rng.choice(GOOD, 30))
        bad = i % 6 == 0
        if bad:
            words[4] = str(rng.choice(BAD))
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return fit_toxicity(docs, spark.createDataFrame(marks, "doc_id long, toxic int"), docs)


@pytest.mark.parametrize(
    "text,word",
    [
        ("you 1d10t there", "idiot"), ("such tr@sh!", "trash"), ("a w0rthle$$ river", "worthless"), ("m o r o n here", "moron"),
        ("m.o.r.o.n", "moron"), ("what an idiooooot", "idiot"), ("5cum.", "scum"), ("IDIOT!!", "idiot"), ("ttrraasshh no", "trash"),
        ("(moron)", "moron"), ("s-c-u-m", "scum"), ("!diot", "idiot"),
    ],
)
def test_disguises_are_undone(toxic_model, text, word):
    found = {w for w in restored_words(text, toxic_model) if toxic_model.weight(w)}
    if text.startswith("ttrr"):
        assert found <= {word}
    else:
        assert word in found and {w[:3] for w in found} == {word[:3]}


def test_clean_words_stay_clean(toxic_model):
    assert {f.rstrip("*") for f in toxic_model.lexicon} >= set(BAD) and toxic_model.chances[0] < 0.05
    for text in ("THE RIVER!! WAS!! CALM!!", "call 555-1234 at 10:30", "a$$$ b 12 c 3", "the the the", "green 2 town a b c d"):
        assert not {w for w in restored_words(text, toxic_model) if toxic_model.weight(w)}


def test_decode_is_the_best_path():
    rng = np.random.default_rng(1)
    log_p = rng.normal(size=SYMBOLS**3).astype(np.float32)
    for token in ("1d10t", "a11", "b00k5", "x$!"):
        best, text = max(_all_paths(lattice(token), log_p))
        assert decode(token, log_p) == text


def _all_paths(steps, log_p):
    from itertools import product

    from tabsift.llm.toxicity import _symbol

    for choice in product(*steps):
        word, score = "", 0.0
        for letter, cost in choice:
            score -= cost
            if letter:
                a, b = (_symbol(word[-2]) if len(word) > 1 else 0), (_symbol(word[-1]) if word else 0)
                score += float(log_p[(a * SYMBOLS + b) * SYMBOLS + _symbol(letter)])
                word += letter
        a, b = (_symbol(word[-2]) if len(word) > 1 else 0), (_symbol(word[-1]) if word else 0)
        yield score + float(log_p[(a * SYMBOLS + b) * SYMBOLS]), word


def test_toxicity_awkward_rows(odd, empty, toxic_model):
    rows = toxicity(odd, toxic_model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (1, 2)} == {toxic_model.chances[0]}
    assert toxicity(empty, toxic_model).count() == 0
    nothing = ToxicityModel(toxic_model.log_p, {}, [0.0] * BINS)
    assert {r.score for r in toxicity(odd, nothing).collect()} == {0.0}


def test_no_labels(spark, odd):
    m = fit_toxicity(odd, spark.createDataFrame([], "doc_id long, toxic int"), odd)
    assert m.lexicon == {} and set(m.chances) == {0.0}


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op6_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    hit = sum(p for t, p in held if t) / max(1, sum(t for t, _ in held))
    false = sum(p for t, p in held if not t) / sum(not t for t, _ in held)
    assert hit > 0.9 and false < 0.02
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_every_feature_is_a_candidate(spark):
    """60,000 general words stand in more toxic texts than the toxic word, which is learned all the same."""
    from tabsift.llm.toxicity import _lexicon

    general = spark.range(60_000).selectExpr("concat('w', id) feature", "9L bad_texts", "9L bad_words", "900L good_texts", "900L good_words")
    own = spark.createDataFrame([("", 100, 90_000, 10_000, 9_000_000), ("vermin", 8, 8, 0, 0)], general.schema)
    assert set(_lexicon(general.unionByName(own))) == {"vermin"}


def test_only_verified_copies_collapse(spark):
    """Texts that share a passage all count; copies and near copies count once."""
    from tabsift.llm.toxicity import _distinct

    rng = np.random.default_rng(8)
    words = [f"{a}{b}{c}" for a in "bdfglm" for b in "aeiou" for c in "nrst"]
    passage = " ".join(rng.choice(words, 60))
    shared = [" ".join([*rng.choice(words, 40), passage, *rng.choice(words, 40)]) for _ in range(40)]
    long = list(rng.choice(words, 300))
    near = [" ".join([*long[:k], "changed", *long[k + 1 :]]) for k in range(20, 280, 20)]
    rows = [(t, 0) for t in shared + shared[:9]] + [(t, 1) for t in near] + [(shared[0], 1), (None, 0), ("", 0)]
    docs = spark.createDataFrame([(i, t or "") for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, x) for i, (_, x) in enumerate(rows)], "doc_id long, toxic int")
    left = _distinct(docs.union(docs.limit(5)), marks).collect()
    got = [(r.text or "", r.toxic) for r in left]
    assert sorted(t for t, x in got if not x) == sorted([*shared, ""])
    assert (shared[0], 1) in got and 1 <= sum(t in near for t, _ in got) <= 3


@pytest.mark.parametrize(
    "text,words",
    [
        ("you are a m o r o n", ["moron"]), ("m o r o n s c u m", ["moron", "scum"]), ('"m o r o n" he said', ["moron"]),
        ("m 0 r o n", ["moron"]), ("$ c u m", ["scum"]), ("t r @ $ h", ["trash"]),
        (" ".join("the river was calm and green while birds sang over quiet fields near town moron and the river was calm and green".replace(" ", "")), ["moron"]),
        ("the-river-was-calm-and-green-while-birds-sang-over-quiet-fields-near-town-while-birds-sang-over-quiet-fields-m0r0n-town", ["moron"]),
        ("m" + "o" * 150 + "r0n", ["moron"]),
    ],
)
def test_disguises_of_any_length_are_split_and_undone(toxic_model, text, words):
    assert set(words) <= set(restored_words(text, toxic_model))
    assert all(any(w.startswith(x[:3]) for w in toxic_model.weigh(text)) for x in words)


def test_a_filter_passes_all_keys_and_few_others(spark):
    from tabsift.llm.common import collect_bits, has_bit, maybe_in

    keys = spark.range(0, 30_000, 3).selectExpr("id as doc_id", "concat('w', id) as word").union(spark.sql("select null, null"))
    rows = spark.range(30_000).selectExpr("id as doc_id", "id % 7 as more").union(spark.sql("select null, 1"))
    passed = {r.doc_id for r in maybe_in(rows, keys, "doc_id").collect()}
    assert set(range(0, 30_000, 3)) <= passed and len(passed) < 10_100 and None not in passed
    bits = collect_bits(keys, "word")
    assert all(has_bit(bits, f"w{i}") for i in range(0, 30_000, 3))
    assert sum(has_bit(bits, f"w{i}") for i in range(1, 30_000, 3)) < 50
    assert not maybe_in(rows, keys.limit(0), "doc_id").collect()


def test_a_settled_path_is_the_best_path():
    """A decoding that is settled on the way equals one that is settled at the end only."""
    from tabsift.llm import toxicity as T

    rng = np.random.default_rng(5)
    log_p = rng.normal(size=SYMBOLS**3).astype(np.float32)
    token = "".join(rng.choice(list("abc01$|-"), 500))
    short = [decode(token, log_p), decode(token, log_p, gaps=True)]
    whole, T.SETTLE = T.SETTLE, 10_000
    try:
        assert short == [decode(token, log_p), decode(token, log_p, gaps=True)]
    finally:
        T.SETTLE = whole


def test_words_are_weighed_only_where_a_feature_begins(toxic_model, monkeypatch):
    """Words that share three letters with a feature but not its beginning, and texts with one stretched word, take the short way."""
    model = ToxicityModel(toxic_model.log_p, {"moron": 3.0, "scum*": 2.5, "vermin*": 2.0, "rat": 2.0}, [0.0] * BINS)
    looked, hits = [], ToxicityModel._hits
    monkeypatch.setattr(ToxicityModel, "_hits", lambda self, token, calm: looked.append(token) or hits(self, token, calm))
    text = "More moral, morose mornings: scuba scurvy. Vermouth rather moron scumbag, vermin verminous rat rats so"
    for low in (text, text + " soooo", text + " sooo mo0rning sc.um m0r0n 'rat' verm"):
        want = {w: x * n for w, n in restored_words(low, model).items() if (x := model.weight(w))}
        assert model.weigh(low) == want and {"moron", "scumbag", "verminous", "rat"} <= set(want)
    assert not {"more", "moral,", "morose", "mornings:", "scuba", "scurvy.", "vermouth", "so", "verm"} & set(looked)


def test_shared_beginnings_are_looked_up_once(monkeypatch):
    from tabsift.llm import toxicity as T

    words = ["beginner", "beginners", "beginning", "begin", "beg", "be", "", "begonia", "begs", "question", "ünders", "beginnings"]
    held, asked = {"beg*", "begi*", "begin*", "beginn*", "beginne*", "beginner", "beg", "que*", "quest*"}, []
    monkeypatch.setattr(T, "has_bit", lambda bits, text: asked.append(text) or text in held)
    begun = {}
    for word in words * 2:
        want = [f for k, f in ((k, word[:k] + "*") for k in T.PREFIXES if k < len(word)) if all(word[:j] + "*" in held for j in range(3, k + 1))]
        want += [word] * (len(word) > 2 and word in held and len(want) == sum(k < len(word) for k in T.PREFIXES))
        assert list(T._wanted(word, b"", begun)) == want
        assert list(T._wanted(word, None, begun)) == T.features(word)
    stars = [f for f in asked if f.endswith("*")]
    assert len(stars) == len(set(stars))


def test_bands_follow_the_smallest_hashes_of_all_runs():
    import xxhash

    from tabsift.llm import toxicity as T

    text = " ".join(f"w{i * i % 7919}" for i in range(9000))
    h = T._run_hashes(text)
    least = np.array([((h ^ x) * (y | np.uint64(1))).min() for x, y in T._REHASH])
    assert len(h) > 4096
    (got,) = T._bands({"doc_id": [1], "text": [text]})["bands"]
    assert got == [xxhash.xxh3_64_intdigest(least[2 * k : 2 * k + 2].tobytes()) - 2**63 for k in range(T.BANDS)]

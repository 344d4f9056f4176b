"""Language identification of mixed-language text.

Word scores are sums of character-trigram log-probabilities learned from labelled texts.  Script ranges
narrow each word's candidates to the languages seen in that script; Viterbi with a penalty for switching
then labels the words, and runs of one label are spans.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import unicode_tables as U
from .common import _slices, drop_idle_coders, map_texts
from .rolling import mix

BUCKETS = 1 << 16
#: Natural-log penalty for a change of language between two words.
SWITCH = 12.0
#: A language is a candidate in a script if this share of its training words is in it.
SCRIPT_SHARE = 0.001
#: The model keeps a row of BUCKETS floats per language; more labels than this are refused.
MAX_LANGUAGES = 500

#: A language's trigram counts are smoothed by this many trigrams with the shares they have in all languages together.
BACKGROUND = 6500.0
#: Characters looked at together (a longer text by itself); the arrays of a portion take about 100 bytes a character.
PORTION = 500_000

FAR = np.float32(-1e6)
LANES = 256


@dataclass
class LanguageModel:
    langs: list[str]
    log_p: np.ndarray  # languages x BUCKETS
    allowed: np.ndarray  # scripts x languages


def _words(texts: list[str]):
    """Trigram bucket of every letter, the letters' positions, where each word's letters begin, and where texts start."""
    cp, starts = U.code_points(texts)
    alpha = U.letters()[cp]
    folded = np.where(alpha, U.lower()[cp], 0).astype(np.uint64)
    at = np.flatnonzero(alpha)
    if not len(at):
        return None, at, at, cp, starts
    before = np.where(at > 0, folded[at - 1], 0)  # the last code point is a line feed, never a letter
    with np.errstate(over="ignore"):
        h = mix((before << np.uint64(42)) ^ (folded[at] << np.uint64(21)) ^ folded[at + 1])
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    return (h >> np.uint64(48)).astype(np.int64), at, first, cp, starts


def fit_language_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from every row with a non-null label; counts are summed per task, then by language and bucket."""
    n_scripts = len(U.SCRIPTS)

    def count(batches):
        import pyarrow as pa

        drop_idle_coders()
        sums: dict[str, np.ndarray] = {}
        for part in (p for batch in batches for p in _slices(batch, "text")):
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                by_lang.setdefault(lang, []).extend(_pieces(text or ""))
            for lang, texts in by_lang.items():
                total = sums.setdefault(lang, np.zeros(BUCKETS + n_scripts, np.int64))
                for some in _portions(texts):
                    bucket, at, first, cp, _ = _words(some)
                    if bucket is not None:
                        total[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
                        total[BUCKETS:] += np.bincount(U.scripts()[cp[at[first]]], minlength=n_scripts)
        for lang, total in sums.items():
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(cells), pa.string()), pa.array(cells, pa.int32()), pa.array(total[cells])],
                names=["lang", "cell", "n"],
            )

    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("lang").isNotNull())
    counts = labelled.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("lang").agg(F.collect_list("cell").alias("cells"), F.collect_list("n").alias("n"))
    rows = sorted(packed.limit(MAX_LANGUAGES + 1).collect())
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = [r["lang"] for r in rows]
    table = np.zeros((len(rows), BUCKETS + n_scripts))
    for i, r in enumerate(rows):
        table[i, r["cells"]] = r["n"]
    grams, words = table[:, :BUCKETS], table[:, BUCKETS:]
    shared = (grams.sum(0) + 1) / (grams.sum() + BUCKETS)  # so that a label with little text is not favoured where it knows nothing
    log_p = np.log((grams + BACKGROUND * shared) / (grams.sum(1, keepdims=True) + BACKGROUND)).astype(np.float32)
    share = words / np.maximum(words.sum(1, keepdims=True), 1)
    return LanguageModel(langs, log_p, (share >= SCRIPT_SHARE).T)


def _pieces(text: str, limit: int = PORTION):
    """A long text in pieces that end at a space, which no word reaches over; one without a space near stays whole until the next."""
    start = 0
    while len(text) - start > limit:
        end = text.rfind(" ", start, start + limit)
        end = end if end > start else text.find(" ", start + limit)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def _portions(texts: list[str], limit: int = PORTION):
    part, n = [], 0
    for t in texts:
        if part and n + len(t) > limit:
            yield part
            part, n = [], 0
        part.append(t)
        n += len(t)
    if part:
        yield part


def viterbi(scores: np.ndarray, starts: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each row of ``scores`` (items x labels); a change of label costs ``penalty``, none at ``starts``.

    Sequences are laid end to end and cut into lanes of equal length that run side by side.  First each lane
    is run from each label it could be entered with; the lanes are then chained, run from the scores they
    are really entered with, and traced back from each label they could end in.
    """
    n, k = scores.shape
    if k == 1 or not n:
        return np.zeros(n, np.int64)
    length = max(1, min(LANES, n))
    lanes = -(-n // length)
    e = np.zeros((lanes * length, k), np.float64)
    e[:n] = scores
    cost = np.full(lanes * length, penalty)
    cost[starts] = 0.0
    e = e.reshape(lanes, length, k).transpose(1, 0, 2)
    cost = np.ascontiguousarray(cost.reshape(lanes, length).T)
    run = np.broadcast_to(np.where(np.eye(k, dtype=bool), 0.0, -np.inf), (lanes, k, k)).copy()  # entered with, now in
    for t in range(length):
        run = np.maximum(run, run.max(2, keepdims=True) - cost[t][:, None, None]) + e[t][:, None, :]
    enter = np.zeros((lanes, k))
    for j in range(1, lanes):
        enter[j] = (enter[j - 1][:, None] + run[j - 1]).max(0)
        enter[j] -= enter[j].max()
    now, moved, best = enter, np.zeros((length, lanes, k), bool), np.zeros((length, lanes), np.int64)
    for t in range(length):
        best[t] = now.argmax(1)
        top = now.max(1, keepdims=True) - cost[t][:, None]
        moved[t] = top > now
        now = np.maximum(now, top) + e[t]
    paths = np.zeros((length, lanes, k), np.int64)
    state = np.broadcast_to(np.arange(k), (lanes, k))
    for t in range(length - 1, -1, -1):
        paths[t] = state
        state = np.where(np.take_along_axis(moved[t], state, 1), best[t][:, None], state)
    labels, end = np.zeros((lanes, length), np.int64), int(now[-1].argmax())
    for j in range(lanes - 1, -1, -1):
        labels[j] = paths[:, j, end]
        end = int(state[j, end])
    return labels.reshape(-1)[:n]


def label_spans(texts: list[str | None], model: LanguageModel, switch: float = SWITCH) -> list[list[tuple[int, int, int, int]]]:
    """Per text: (first character, end character, language index, letters) of each span; no letter: no span."""
    out: list[list] = []
    for part in _portions([t or "" for t in texts]):
        out.extend(_label_part(part, model, switch))
    return out


def _label_part(texts: list[str], model: LanguageModel, switch: float) -> list[list]:
    spans: list[list] = [[] for _ in texts]
    bucket, at, first, cp, starts = _words(texts)
    if bucket is None or not model.langs:
        return spans
    scores = np.stack([np.add.reduceat(row[bucket], first) for row in model.log_p], axis=1)
    allowed = model.allowed[U.scripts()[cp[at[first]]]]
    scores = np.where(allowed | ~allowed.any(1, keepdims=True), scores, FAR)
    doc = np.searchsorted(starts, at[first], side="right") - 1
    new_doc = np.flatnonzero(np.diff(doc, prepend=-1))
    label = viterbi(scores, new_doc, switch)
    size = np.diff(np.append(first, len(at)))
    ends = at[first + size - 1] + 1
    change = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
    n_letters = np.add.reduceat(size, change)
    last = np.append(change[1:], len(doc)) - 1
    for c, z, n in zip(change.tolist(), last.tolist(), n_letters.tolist()):
        d = int(doc[c])
        spans[d].append((int(at[first[c]] - starts[d]), int(ends[z] - starts[d]), int(label[c]), n))
    return spans


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """``doc_id, lang_pred, score, spans array<struct<first,last,lang,letters>>``; one row per input row.

    ``lang_pred`` is the language of most letters (ties: first by name), ``score`` its share of them.  Null
    texts and texts without a letter are ``und`` with score 0 and no spans.  Spans are half-open character ranges.
    A model without languages labels everything ``und``.  Whole texts are read; ids may be null or repeat; other
    columns are ignored; an empty table gives no rows.
    """

    def fn(cols):
        out = {"doc_id": cols["doc_id"], "lang_pred": [], "score": [], "spans": []}
        for spans in label_spans(cols["text"], model, switch):
            letters = np.zeros(len(model.langs) + 1)
            for *_, label, n in spans:
                letters[label] += n
            total = letters.sum()
            out["lang_pred"].append(model.langs[int(letters.argmax())] if total else "und")
            out["score"].append(float(letters.max() / total) if total else 0.0)
            out["spans"].append([{"first": a, "last": b, "lang": model.langs[c], "letters": n} for a, b, c, n in spans])
        return out

    view = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, lang_pred string, score double, spans array<struct<first: int, last: int, lang: string, letters: int>>"
    return map_texts(view, fn, schema)


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text :func:`identify` gives a language to (no ``und``)."""
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        drop_idle_coders()
        for part in (p for batch in batches for p in _slices(batch, text_col)):
            yield part.filter(pa.array([bool(s) for s in label_spans(part.column(at).to_pylist(), model)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

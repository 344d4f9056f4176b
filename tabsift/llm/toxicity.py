"""Toxicity by noisy-channel deobfuscation.

A character trigram model of the corpus and a lexicon of words and word beginnings that mark toxic training texts are
learned.  Tokens that look disguised (look-alike characters, letters apart, stretched letters) become lattices of
what each observed character may stand for; Viterbi under the character model picks the restored spelling, and the
restored words are scored.  Tokens without any alternative have one path through the lattice, themselves.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass, field
from os.path import commonprefix

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import unicode_tables as U
from .common import collect_bits, has_bit, join_hot, map_texts, maybe_in

# What a look-alike character may stand for.
LOOKALIKES = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "€": "e",
    "£": "l",
    "(": "c",
    "*": "aeiou",
}

#: Log-costs of the channel: a character read as its look-alike, and one letter dropped from a stretched run.
SWAP, SQUEEZE = 1.0, 0.2
SYMBOLS = 64
SMOOTH = 5.0

#: A feature is a word or its first few letters.
PREFIXES = range(3, 8)
#: Candidate features are all that stand in at least MIN_TEXTS toxic training texts.
MIN_TEXTS = 3
#: A feature's log-likelihood ratio must exceed 2 ln V + MIN_RATIO, V being the number of candidates, so that few get in by
#: chance whatever the size of the vocabulary; and its weight, the log of its share among words of toxic texts over that among
#: others less CAUTION standard errors, must reach MIN_WEIGHT.
MIN_RATIO, MIN_WEIGHT, CAUTION = 2.0, 2.0, 1.0
#: Smallest hashes of a text that stand for its runs of five words, the Jaccard similarity of near copies, bands in which they are sought.
SKETCH, SIMILAR, BANDS = 256, 0.8, 8
_REHASH = np.random.default_rng(42).integers(0, 2**64, (2 * BANDS, 2), np.uint64, endpoint=False)
_RUN_MULT = np.uint64(0x9E3779B97F4A7C15)
#: Width and number of the bins in which sums of word weights are turned into probabilities.
BIN, BINS = 0.5, 400
#: Tokens a task remembers at a time, and their length; others are worked out again.
REMEMBERED, REMEMBERED_CHARS = 200_000, 100
#: Features a task counts before it passes its sums on.
HELD = 1_000_000
#: Characters between two looks for what all paths of a lattice share.
SETTLE = 64

_WORD = re.compile(r"[^\W\d_]+")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
#: A character that may stand apart (a ``*`` only between white space), what may separate two, and what may stand around a run.
_ITEM, _GAP = r"(?:[^\W_]|[@$!|+€£(]|(?<=\s)\*(?=\s))", r"(?:[ .\-_~]|(?<!\s)\*|\*(?!\s))"
_BEFORE, _AFTER = r"(?<![^\s\"'(\[{<“‘«])", r"(?![^\s.,;:!?\"')\]}>”’»])"
_APART = re.compile(f"{_BEFORE}{_ITEM}(?:{_GAP}{{1,2}}{_ITEM}){{2,}}{_AFTER}")
#: What every match of _APART holds: a character between separators and one more standing alone.
_MAYBE_APART = re.compile(f"{_GAP}{_ITEM}{_GAP}{{1,2}}{_ITEM}{_AFTER}")
#: The same without its conditions: most texts have no such place and are told apart by this quicker search.
_SINGLE = re.compile(r"[ .\-_~*](?:[^\W_]|[@$!|+€£(*])[ .\-_~*]{1,2}(?:[^\W_]|[@$!|+€£(*])(?![^\s.,;:!?\"')\]}>”’»])")
_LOOKALIKE = re.compile("[" + re.escape("".join(LOOKALIKES)) + "]")
_GAPS = re.compile(f"{_GAP}+")
_RIM = ".,;:?\"'()[]{}<>!-_~"


@dataclass
class ToxicityModel:
    log_p: np.ndarray  # SYMBOLS ** 3
    lexicon: dict[str, float]  # feature -> weight
    chances: list[float]  # share of toxic texts by bin of the sum of weights, never falling
    memory: dict[str, str] = field(default_factory=dict)  # spellings of disguised tokens
    tokens: dict[str, tuple] = field(default_factory=dict)  # (word, weight) pairs of tokens that have any
    plain: set[str] = field(default_factory=set)  # tokens without any
    heads: frozenset | None = None
    begins: frozenset | None = None

    def __getstate__(self):
        own = {"log_p": self.log_p.astype(np.float32), "lexicon": self.lexicon, "chances": self.chances}
        return own | {"memory": {}, "tokens": {}, "plain": set(), "heads": None, "begins": None}

    def weight(self, word: str) -> float:
        """The largest weight of the word's features; 0 if none is in the lexicon."""
        return max((self.lexicon.get(f, 0.0) for f in features(word)), default=0.0)

    def weigh(self, text: str | None) -> dict[str, float]:
        """Weights of the text's restored words that have any, times their number."""
        out: dict[str, float] = {}
        low = (text or "").lower()
        known, plain, long = self.tokens, self.plain, {}
        if len(known) + len(plain) >= REMEMBERED:
            known.clear()
            plain.clear()
        counts = Counter(low.split())
        rest = counts.keys() - plain
        fresh = [t for t in rest if t not in known]
        calm, heads, begins = not _STRETCHED.search(" ".join(fresh)), self._heads(), self._begins()
        for token in fresh:
            if token[:3] not in heads or begins.isdisjoint((token[:3], token[:4], token[:5])):
                if token.rstrip(_RIM).isalpha() and len(token) <= REMEMBERED_CHARS and (calm or not _STRETCHED.search(token)):
                    plain.add(token)  # as _hits says of most tokens
                    continue
            hits = self._hits(token, calm)
            if len(token) > REMEMBERED_CHARS:
                long[token] = hits
            elif hits:
                known[token] = hits
            else:
                plain.add(token)
        for token in rest:
            for w, x in known.get(token) or long.get(token, ()):
                out[w] = out.get(w, 0.0) + x * counts[token]
        for w in spaced_words(low, self):
            if w not in out and (x := self.weight(w)):
                out[w] = x
        return out

    def _hits(self, token: str, calm: bool) -> tuple:
        """Weighed words of the token; ``calm`` says that no letter of it is stretched."""
        core = token.strip(_RIM)
        begins = self._begins()
        if core.isalpha() and begins.isdisjoint((core[:3], core[:4], core[:5])) and token[0] == core[0] and (calm or not _STRETCHED.search(core)):
            return ()  # a plain word that no feature begins
        words = _WORD.findall(token)
        if all(begins.isdisjoint((w[:3], w[:4], w[:5])) for w in words):
            if not words or (not _LOOKALIKE.search(token) and (calm or not _STRETCHED.search(token))):
                return ()  # nothing but its words, which no feature begins
            if not token.isalpha() and not self._reaches(token):
                return ()  # nothing that the token may disguise begins like a feature
        return tuple((w, x) for w in token_words(token, self) if (x := self.weight(w)))

    def _reaches(self, token: str) -> bool:
        """Whether some path through a lattice of the token begins like a feature."""
        core = token.strip(_RIM)
        starts = [(core, i) for i in range(1, len(core)) if _is_gap(core[i - 1]) and not _is_gap(core[i])]
        for part, start in [*((p, 0) for p in {token.rstrip(_RIM), core, *_WORD.findall(token)}), *starts]:
            begun = {""}
            for options in _steps(part, start):
                begun = {b if len(b) == 3 else b + letter for b in begun for letter, _ in options}
                if all(len(b) == 3 for b in begun):
                    break
            if not begun.isdisjoint(self._heads()):
                return True
        return False

    def _heads(self) -> frozenset[str]:
        """First three letters of the lexicon's features."""
        if self.heads is None:
            self.heads = frozenset(f[:3] for f in self.lexicon)
        return self.heads

    def _begins(self) -> frozenset[str]:
        """First five letters of the lexicon's features, all of a shorter one's: a word that begins with none has no weight."""
        if self.begins is None:
            self.begins = frozenset(f.rstrip("*")[:5] for f in self.lexicon)
        return self.begins

    def chance(self, weights: dict[str, float]) -> float:
        return self.chances[_bin(sum(weights.values()))]


def features(word: str) -> list[str]:
    """The word and its beginnings (marked ``*``); none for words of fewer than three letters."""
    return [word, *(word[:k] + "*" for k in PREFIXES if k < len(word))] if len(word) > 2 else []


def _bin(weight: float) -> int:
    return min(BINS - 1, math.ceil(weight / BIN))


def _symbol(c: str) -> int:
    """0: anything but a letter; 1..26: a..z; 27..63: other letters, by code point."""
    o = ord(c)
    if 97 <= o <= 122:
        return o - 96
    return 27 + o % 37 if c.isalpha() else 0


def _symbols() -> np.ndarray:
    table = np.where(U.letters(), 27 + U.lower() % 37, 0).astype(np.int64)
    for o in range(97, 123):
        table[o] = table[o - 32] = o - 96
    return table


def fit_characters(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-probabilities of a character given the two before, counted over all texts and interpolated with shorter contexts."""

    def count(batches):
        import pyarrow as pa

        table, total = _symbols(), np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            column = batch.column(0)
            for start in range(0, batch.num_rows, 256):
                texts = [t or "" for t in column.slice(start, 256).to_pylist()]
                for part in _portions(texts):
                    s = np.concatenate([[0], table[U.code_points(part)[0]]])
                    if len(s) > 2:
                        total += np.bincount(s[:-2] * SYMBOLS**2 + s[1:-1] * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    sums = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    tri = np.zeros(SYMBOLS**3)
    for cell, n in sums.collect():  # at most SYMBOLS ** 3 rows
        tri[cell] = n
    tri = tri.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    uni = (tri.sum((0, 1)) + 1) / (tri.sum() + SYMBOLS)
    bi = (tri.sum(0) + SMOOTH * uni) / (tri.sum((0, 2))[:, None] + SMOOTH)
    full = (tri + SMOOTH * bi[None]) / (tri.sum(2, keepdims=True) + SMOOTH)
    return np.log(full).astype(np.float32).reshape(-1)


def _portions(texts: list[str], limit: int = 2_000_000):
    part, n = [], 0
    for t in texts:
        if part and n + len(t) > limit:
            yield part
            part, n = [], 0
        part.append(t)
        n += len(t)
    if part:
        yield part


def fit_toxicity(docs: DataFrame, labels: DataFrame, corpus: DataFrame, text_col: str = "text") -> ToxicityModel:
    """Learn from ``docs(doc_id, text)`` joined with ``labels(doc_id, toxic)`` and the character statistics of ``corpus``.

    Copies and near copies (:func:`_distinct`) count once per label, else every word of a much copied toxic text would look
    toxic.  All labelled texts are read.  Features of toxic texts are counted first; those in at least MIN_TEXTS of
    them are candidates, and only candidates are counted in the other texts (a filter of fixed size drops most others before
    they move, the join with the candidates the rest).  The tests run in Spark, and only features that pass
    them and BINS rows come to the driver.  Sums of word weights over the training texts then give the share of toxic
    ones by bin, made monotone.  Without toxic rows every score is the share of toxic rows (0 without any).
    """
    log_p = fit_characters(corpus, text_col)
    marks = labels.where(F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    marked = materialize(_distinct(docs.select("doc_id", F.coalesce(F.col(text_col), F.lit("")).alias("text")), marks))
    blank = ToxicityModel(log_p, {}, [0.0] * BINS)
    lexicon = _lexicon(materialize(_counts(marked, blank)))
    if lexicon is None:
        return blank
    model = ToxicityModel(log_p, lexicon, [0.0] * BINS)
    model.chances = _chances(marked, model)
    return model


def _distinct(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``text, toxic`` of the labelled texts without copies and near copies within a label.

    Equal texts are one.  A text goes only if it shares a band (two minima of re-hashed runs of five words) with the first text of
    that band, in the order of their hashes, and a Jaccard similarity of at least SIMILAR with it: exact for texts of up to
    SKETCH different runs together, else estimated from the SKETCH smallest hashes (standard error 0.025).  So the first of each
    chain of copies stays, whatever the order of rows, and a shared passage alone drops nothing.

    Digests and bands are all that is compared and moved.  Smallest hashes are worked out and moved for texts that share a
    band only, and texts are moved once, those that stay; which rows may be meant is known before the move from a filter of fixed size.
    """
    labelled = maybe_in(docs, marks, "doc_id")
    sketches = map_texts(labelled, _bands, "doc_id long, digest string, bands array<long>")
    once = sketches.join(marks, "doc_id").groupBy("digest", "toxic").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    once = materialize(once.withColumn("mark", F.xxhash64("digest", "toxic")))
    banded = once.select("mark", "toxic", F.posexplode("bands").alias("k", "band")).select("mark", F.xxhash64("toxic", "k", "band").alias("band"))
    firsts = materialize(banded.groupBy("band").agg(F.min("mark").alias("first"), F.count("*").alias("rows")).where("rows > 1"))
    pairs = join_hot(banded, firsts, "band", "rows", BANDS * once.count()).where("mark <> first").select("mark", "first").distinct()
    pairs = materialize(pairs)
    met = pairs.select("mark").union(pairs.select("first")).distinct().join(once.drop("bands"), "mark")
    lows = materialize(map_texts(_texts_of(labelled, materialize(met)), _lows, "mark long, low binary"))
    others = pairs.groupBy("first").agg(F.count("*").alias("rows")).join(lows.select(F.col("mark").alias("first"), F.col("low").alias("first_low")), "first")
    both = join_hot(pairs.join(lows, "mark"), others, "first", "rows", pairs.count()).select("mark", "low", "first_low")

    def similar(batches):
        import pyarrow as pa

        for batch in batches:
            near = [m for m, x, y in zip(*(c.to_pylist() for c in batch.columns)) if _jaccard(x, y) >= SIMILAR]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.int64())], names=["mark"])

    gone = both.mapInArrow(similar, "mark long").distinct()
    kept = materialize(once.drop("bands").join(gone, "mark", "left_anti"))
    return _texts_of(labelled, kept).select("text", "toxic")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``text`` joined to each row of ``wanted(doc_id, digest, ...)``; rows that repeat become one before they move."""
    rows = maybe_in(docs, wanted, "doc_id").select("doc_id", F.md5("text").alias("digest"), "text")
    return rows.groupBy("doc_id", "digest").agg(F.first("text").alias("text")).join(wanted, ["doc_id", "digest"])


def _run_hashes(text: str) -> np.ndarray:
    """Hashes of the text's different runs of five words, ascending; of the whole sequence if there are fewer words."""
    words = text.lower().split()
    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    h = np.zeros(max(5, len(words)), np.uint64)
    h[: len(words)] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(h) - 4
    runs = np.zeros(n, np.uint64)
    for j in range(5):
        runs = (runs ^ (runs >> np.uint64(29))) * _RUN_MULT + h[j : j + n]
    runs ^= runs >> np.uint64(32)
    return np.unique(runs * _RUN_MULT)


def _least(h: np.ndarray) -> np.ndarray:
    return ((h ^ _REHASH[:, :1]) * (_REHASH[:, 1:] | np.uint64(1))).min(1, keepdims=True)


def _bands(cols):
    out = {"doc_id": cols["doc_id"], "digest": [], "bands": []}
    for text in cols["text"]:
        h = _run_hashes(text)
        least = np.concatenate([_least(h[i : i + 4096]) for i in range(0, len(h), 4096)], axis=1).min(1)
        out["digest"].append(hashlib.md5(text.encode()).hexdigest())
        out["bands"].append([xxhash.xxh3_64_intdigest(least[2 * k : 2 * k + 2].tobytes()) - 2**63 for k in range(BANDS)])
    return out


def _lows(cols):
    return {"mark": cols["mark"], "low": [_run_hashes(text)[:SKETCH].tobytes() for text in cols["text"]]}


def _jaccard(x: bytes, y: bytes) -> float:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    least = np.union1d(a, b)[:SKETCH]
    return float((np.isin(least, a) & np.isin(least, b)).mean())


def _counts(marked: DataFrame, model: ToxicityModel) -> DataFrame:
    """``feature, bad_texts, bad_words, good_texts, good_words`` of all candidates; ``""`` stands for all words."""
    bad = materialize(_feature_counts(marked.where("toxic = 1"), model)).where((F.col("texts") >= MIN_TEXTS) | (F.col("feature") == ""))
    good = _feature_counts(marked.where("toxic <> 1"), model, collect_bits(bad, "feature"))
    named = [x.select("feature", F.col("texts").alias(f"{label}_texts"), F.col("words").alias(f"{label}_words")) for x, label in ((bad, "bad"), (good, "good"))]
    return named[0].join(named[1], "feature", "left").fillna(0)


def _lexicon(counts: DataFrame) -> dict[str, float] | None:
    """Weights of the features that pass both tests, from the counts of all candidates; None without toxic texts."""
    whole = counts.where(F.col("feature") == "").first()
    if whole is None or not whole["bad_texts"]:
        return None
    candidates = counts.where((F.col("bad_texts") >= MIN_TEXTS) & (F.col("feature") != ""))
    bar = 2 * math.log(max(1, candidates.count())) + MIN_RATIO
    a, b = F.col("bad_texts"), F.col("good_texts")
    bad_share = F.log((F.col("bad_words") + 0.5) / F.lit(whole["bad_words"] + 1.0))
    good_share = F.log((F.col("good_words") + 0.5) / F.lit(whole["good_words"] + 1.0))
    sure = bad_share - good_share - F.lit(CAUTION) * F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    weighed = candidates.select("feature", sure.alias("sure"), _ratio(a, whole["bad_texts"], b, whole["good_texts"]).alias("ratio"))
    return {r["feature"]: r["sure"] for r in weighed.where((F.col("sure") >= MIN_WEIGHT) & (F.col("ratio") >= bar)).collect()}


def _ratio(a: Column, n: int, b: Column, m: int) -> Column:
    """Log-likelihood ratio of a feature in ``a`` of ``n`` against ``b`` of ``m`` texts; 0 if no more frequent in the first."""
    if not m:
        return 2 * a * math.log(2)
    part = lambda k, t, p: F.when(k > 0, k * F.log(k / F.lit(float(t)) / p)).otherwise(0.0)
    p = (a + b) / F.lit(float(n + m))
    ratio = 2 * (part(a, n, p) + part(b, m, p) + part(n - a, n, 1 - p) + part(m - b, m, 1 - p))
    return F.when(a / F.lit(float(n)) > b / F.lit(float(m)), ratio).otherwise(0.0)


def _wanted(word: str, bits: bytes | None, begun: dict[str, tuple]) -> tuple[str, ...]:
    """Features of the word that the filter holds; ``begun`` remembers those of its beginnings."""
    if bits is None:
        return tuple(features(word))
    if len(word) < 3:
        return ()
    stem = word[: min(PREFIXES[-1], len(word) - 1)]
    own, all_held = begun.get(stem) or _beginnings(stem, bits, begun)
    return (*own, word) if all_held and has_bit(bits, word) else own


def _beginnings(stem: str, bits: bytes, begun: dict[str, tuple]) -> tuple[tuple[str, ...], bool]:
    """Features that are the stem or begin it, up to the first that the filter lacks, and whether it lacks none.  A text that
    holds a word holds its beginnings, so once a beginning is not a candidate no longer one is."""
    if len(stem) < PREFIXES[0]:
        return (), True
    own, all_held = begun.get(stem[:-1]) or _beginnings(stem[:-1], bits, begun)
    all_held = all_held and has_bit(bits, stem + "*")
    begun[stem] = ((*own, stem + "*") if all_held else own, all_held)
    return begun[stem]


def _feature_counts(marked: DataFrame, model: ToxicityModel, bits: bytes | None = None) -> DataFrame:
    """``feature, texts, words``: texts that hold a feature (with ``bits``, one that the filter holds) and its
    occurrences, summed per task first; ``""`` stands for all.  A task holds at most HELD features and passes its sums on."""

    def count(batches):
        import pyarrow as pa

        in_texts, in_words, known, begun, held = Counter(), Counter({"": 0}), {}, {}, 0

        def learn(fresh):
            calm = not _STRETCHED.search(" ".join(fresh))
            for token in fresh:
                core = token.rstrip(_RIM)
                if core.isalpha() and (calm or not _STRETCHED.search(core)):
                    known[token] = [(core,), _wanted(core, bits, begun), 0]  # as token_words says of most tokens
                    continue
                words = token_words(token, model)
                known[token] = [words, tuple(f for w in words for f in _wanted(w, bits, begun)), 0]

        def settle():
            for words, own, n in known.values():
                in_words[""] += n * len(words)
                for f in own:
                    in_words[f] += n
            known.clear()
            begun.clear()

        def sums():
            names = list(in_texts.keys() | {""})
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[f] for f in names], pa.int64()) for c in (in_texts, in_words))], names=["feature", "texts", "words"])
            in_texts.clear()
            in_words.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                low = text.lower()
                counts = Counter(low.split())
                fresh = [t for t in counts if t not in known]
                learn(fresh)
                held += sum(map(len, fresh))
                seen = {""}
                for token, n in counts.items():
                    entry = known[token]
                    entry[2] += n
                    seen.update(entry[1])
                apart = spaced_words(low, model)
                if apart:
                    for word in apart.difference(*(known[token][0] for token in counts)):
                        own = _wanted(word, bits, begun)
                        seen.update(own)
                        in_words.update(["", *own])
                in_texts.update(seen)
                if len(known) >= REMEMBERED or held >= REMEMBERED * REMEMBERED_CHARS or len(in_texts) >= HELD:
                    settle()
                    held = 0
                if len(in_texts) >= HELD:
                    yield sums()
        settle()
        yield sums()

    rows = marked.select("text").mapInArrow(count, "feature string, texts long, words long")
    none = marked.sparkSession.createDataFrame([("", 0, 0)], "feature string, texts long, words long")
    return rows.union(none).groupBy("feature").agg(F.sum("texts").alias("texts"), F.sum("words").alias("words"))


def _chances(marked: DataFrame, model: ToxicityModel) -> list[float]:
    """Share of toxic texts by bin of the weight sum, pooled until it never falls (adjacent violators)."""

    def place(cols):
        return {"toxic": cols["toxic"], "bin": [_bin(sum(model.weigh(t).values())) for t in cols["text"]]}

    rows = map_texts(marked, place, "toxic int, bin int").groupBy("bin").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).collect()
    blocks: list[list[float]] = []  # bad, n, bins
    seen = {r["bin"]: (r["bad"], r["n"]) for r in rows}
    for k in range(BINS):
        bad, n = seen.get(k, (0, 0))
        blocks.append([bad, n, 1])
        while len(blocks) > 1 and (not blocks[-1][1] or not blocks[-2][1] or blocks[-2][0] * blocks[-1][1] > blocks[-1][0] * blocks[-2][1]):
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last)]
    return [bad / n if n else 0.0 for bad, n, size in blocks for _ in range(size)]


def _is_gap(c: str) -> bool:
    return not c.isalpha() and c not in LOOKALIKES


def _steps(token: str, start: int = 0, gaps: bool = False):
    last = ""
    for i in range(start, len(token)):
        c = token[i]
        if c.isalpha():
            options = [(c, 0.0)]
        elif c in LOOKALIKES:
            options = [(x, SWAP) for x in LOOKALIKES[c]]
        else:
            options = [("", 0.0), (" ", 0.0)] if gaps else [("", 0.0)]
        if last == c and options[0][0]:
            options = [*options, ("", SQUEEZE)]
        if not (gaps and _is_gap(c)):
            last = c
        yield options


def lattice(token: str, gaps: bool = False) -> list[list[tuple[str, float]]]:
    """For each observed character the intended letters (``""``: none) and their log-costs.

    A look-alike may stand for its letters; a letter that repeats the one before may be a stretch.  With ``gaps``, any other
    character may also end a word (``" "``), and a letter repeated across it may be a stretch.
    """
    return list(_steps(token, 0, gaps))


def decode(token: str, log_p: np.ndarray, gaps: bool = False) -> str:
    """The likeliest restored spelling of a token: Viterbi over (last two letters) under the character model.

    With ``gaps`` the best path also splits the token into words.  What all paths share is set aside every SETTLE
    characters, so a token of any length is decoded in time that follows its length.
    """
    at = memoryview(np.ascontiguousarray(log_p))  # gives Python floats
    states: dict[tuple[str, str], tuple[float, str, int]] = {("", ""): (0.0, "", 0)}  # score, text, place of the context in log_p
    settled: list[str] = []
    for i, options in enumerate(_steps(token, 0, gaps)):
        nxt: dict[tuple[str, str], tuple[float, str, int]] = {}
        signs = [(letter, cost, _symbol(letter) if letter else 0) for letter, cost in options]
        for (a, b), (score, text, base) in states.items():
            for letter, cost, sign in signs:
                if letter:
                    key, value = (b, letter), score - cost + at[base + sign]
                    if key not in nxt or value > nxt[key][0]:
                        nxt[key] = (value, text + letter, (base // SYMBOLS % SYMBOLS * SYMBOLS + sign) * SYMBOLS)
                else:
                    key, value = (a, b), score - cost
                    if key not in nxt or value > nxt[key][0]:
                        nxt[key] = (value, text, base)
        states = nxt
        if i % SETTLE == SETTLE - 1 and (shared := commonprefix([text for _, text, _ in states.values()])):
            settled.append(shared)
            states = {key: (score, text[len(shared) :], base) for key, (score, text, base) in states.items()}
    ends = [(score + at[base], text) for score, text, base in states.values()]
    return "".join(settled) + max(ends)[1]


def spellings(token: str, model: ToxicityModel) -> list[str]:
    """Words a disguised token may hold: its Viterbi decoding, also without look-alikes at its end (``stop!!``), and the words
    into which its gaps split it."""
    if (known := model.memory.get(token)) is not None:
        return known.split("\n")
    bare = token.strip(_RIM)
    words = {decode(t, model.log_p) for t in {_GAPS.sub("", token) if " " in token else token.rstrip(_RIM), _GAPS.sub("", bare) if " " in bare else bare} if len(t) > 2}
    if any(map(_is_gap, bare)):
        words.update(decode(bare, model.log_p, gaps=True).split())
    if len(token) <= REMEMBERED_CHARS:
        if len(model.memory) >= REMEMBERED:
            model.memory.clear()
        model.memory[token] = "\n".join(words)
    return list(words)


def token_words(token: str, model: ToxicityModel) -> list[str]:
    """Words in a lower-cased token, then those it may disguise."""
    words = _WORD.findall(token)
    extra: set[str] = set()
    if not token.isalpha():
        core = token.rstrip(_RIM)
        if not core.isalpha() and any(c in LOOKALIKES for c in core) and any(c.isalpha() for c in core):
            extra.update(spellings(token, model))
    for word in words:
        if _STRETCHED.search(word):
            extra.update(spellings(word, model))
    return words + [w for w in sorted(extra) if w and w not in words]


def spaced_words(low: str, model: ToxicityModel) -> set[str]:
    """Words written with their letters apart; a run's first or last character may be a word beside it (``a m o r o n``)."""
    if not _SINGLE.search(low) or not _MAYBE_APART.search(low):
        return set()
    runs = {_GAPS.sub(" ", spaced) for spaced in _APART.findall(low)}
    ends = {part for run in runs if run.count(" ") > 2 for part in (run.split(" ", 1)[1], run.rsplit(" ", 1)[0])}
    return {w for run in runs | ends for w in spellings(run, model) if w}


def restored_words(text: str | None, model: ToxicityModel) -> Counter:
    """Lower-cased words of the text with their number, and those of its disguised parts as restored."""
    low = (text or "").lower()
    words: Counter = Counter()
    for token, n in Counter(low.split()).items():
        for word in token_words(token, model):
            words[word] += n
    for word in spaced_words(low, model):
        words.setdefault(word, 1)
    return words


def toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score double, toxic_words array<string>``; one row per input row, whole texts.

    ``toxic_words`` are the restored words of positive weight.  Null and empty texts have no words and get the share of toxic
    training texts without a lexicon word.  Ids may be null or repeat; other columns are ignored; an empty
    table gives no rows.
    """

    def fn(cols):
        out = {"doc_id": cols["doc_id"], "score": [], "toxic_words": []}
        for text in cols["text"]:
            weights = model.weigh(text)
            out["score"].append(model.chance(weights))
            out["toxic_words"].append(sorted(weights))
        return out

    view = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(view, fn, "doc_id long, score double, toxic_words array<string>")

"""Language-model scoring by deleted interpolation.

The model mixes the maximum-likelihood estimates of all orders up to ``order`` and a uniform one.  The weights depend on the
frequency of the longest context seen (its order and the logarithm of its count) and are learned by
expectation-maximisation on a part of the training documents whose counts are left out meanwhile.

Counts are looked up, never broadcast.  Texts are laid into slices.  Each slice sends its distinct n-grams, as sorted 64-bit
keys with their frequencies, to the key ranges; a range sums the frequencies of the training slices and answers every slice
with the counts of its keys, in their order.  So a frequent n-gram costs one key a slice, whatever its count, and ranges
are even because keys are hashes.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .rolling import mix

#: Bytes of text in a slice (a longer text is a slice of its own) and per range of keys.
SLICE_BYTES = 8_000_000
RANGE_BYTES = 8_000_000
#: Bytes of text hashed at a time.
PORTION = 1_000_000
#: One part in so many of the training documents is left out of the counts while the weights are learned.
DELETED = 16
#: Expectation-maximisation ends when a round gains less than this per left-out token (natural logarithm).
TOLERANCE = 1e-4
ROUNDS = 500

FIT, LEFT_OUT, OTHER = 0, 1, 2

# Fixed value: words end at a space or at one of 09-0D.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_LETTER = np.random.Generator(np.random.PCG64(12)).integers(1, 2**63, 256, dtype=np.uint64)
_POWER, _NEXT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_START, _END = np.uint64(0x1B873593CC9E2D51), np.uint64(0x85EBCA77C2B2AE63)
_TAG = np.uint64(7)  # the low bits of a key are its order


# ---------------------------------------------------------------- tokens and keys


def _word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of folded bytes, and where it begins."""
    inside = buf != 32
    edge = np.diff(inside.astype(np.int8), prepend=0)
    first = np.flatnonzero(edge == 1)
    if not len(first):
        return np.zeros(0, np.uint64), first
    at = np.flatnonzero(inside)
    size = np.diff(np.append(np.searchsorted(at, first), len(at)))
    offset = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(int(size.max()), _POWER))
        return mix(np.add.reduceat(_LETTER[buf[at]] * powers[offset], np.cumsum(size) - size)), first


def _pieces(buf: np.ndarray):
    """Bounds of pieces of about PORTION bytes that end at a space (a longer word stays whole)."""
    gaps, start = np.flatnonzero(buf == 32), 0
    while start < len(buf):
        i = np.searchsorted(gaps, start + PORTION, side="right") - 1
        if i < 0 or gaps[i] <= start:
            i += 1
        end = int(gaps[i]) + 1 if i < len(gaps) else len(buf)
        yield start, end
        start = end


def token_hashes(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts in a row, each text after ``order - 1`` start marks and before its end mark, and where texts begin."""
    folded = b" ".join(texts).translate(_FOLD) + b" "
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    buf = np.frombuffer(folded, np.uint8)
    hashes, firsts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, z in _pieces(buf):
        h, first = _word_hashes(buf[a:z])
        hashes.append(h)
        firsts.append(first + a)
    words, first = np.concatenate(hashes), np.concatenate(firsts)
    n_words = np.diff(np.searchsorted(first, begins))
    size = n_words + order
    start = np.cumsum(size) - size
    tokens = np.full(int(size.sum()), _START, np.uint64)
    tokens[np.arange(len(words)) + np.repeat(start + order - 1 - (np.cumsum(n_words) - n_words), n_words)] = words
    tokens[start + size - 1] = _END
    return tokens, start


def ngram_keys(tokens: np.ndarray, order: int) -> list[np.ndarray]:
    """Per order the keys of the n-grams that end at each token (without meaning where they would begin before the text)."""
    keys, h = [], tokens
    with np.errstate(over="ignore"):
        for k in range(1, order + 1):
            if k > 1:
                h = mix(np.concatenate([h[:1], h[:-1]]) * _NEXT + tokens)
            keys.append((h & ~_TAG) | np.uint64(k))
    return keys


def distinct_keys(keys: list[np.ndarray], start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of all orders, and their frequencies."""
    place = np.arange(len(keys[0])) - np.repeat(start, np.diff(np.append(start, len(keys[0]))))
    return np.unique(np.concatenate([own[place >= k] for k, own in enumerate(keys)]), return_counts=True)


# ---------------------------------------------------------------- packed columns


def pack_numbers(values: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(np.uint64)


def pack_keys(keys: np.ndarray) -> bytes:
    return pack_numbers(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(data), dtype=np.uint64)


def range_bounds(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of ``ranges`` equal ranges of key space begins among sorted keys, and the end."""
    marks = np.array([-(-(i << 64) // ranges) for i in range(ranges)], np.uint64)
    return np.append(np.searchsorted(keys, marks), len(keys))


_SLICE = "slice long, part int, n_bytes long, doc_ids array<long>, n_texts array<long>, texts binary"


def lay_slices(docs: DataFrame, part: Column, id_col: str, text_col: str, slice_bytes: int) -> DataFrame:
    """Texts in slices of about ``slice_bytes``, each of documents of one part."""
    import pyarrow as pa

    from .common import _arrow_schema

    arrow = _arrow_schema(docs, _SLICE)

    def lay(batches):
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        waiting: dict[int, tuple[list, list]] = {}
        sizes: dict[int, int] = {}

        def slice_of(part):
            nonlocal made
            ids, texts = waiting.pop(part)
            del sizes[part]
            made += 1
            whole = b"".join(texts)
            row = [base + made, part, len(whole), ids, [len(t) for t in texts], zstandard.ZstdCompressor(level=3).compress(whole)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, text, part = (batch.column(c)[i].as_py() for c in range(3))
                data = (text or "").encode()
                if part in sizes and sizes[part] + len(data) > slice_bytes:
                    yield slice_of(part)
                ids, texts = waiting.setdefault(part, ([], []))
                ids.append(doc_id)
                texts.append(data)
                sizes[part] = sizes.get(part, 0) + len(data) + 64
        for part in list(waiting):
            yield slice_of(part)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col), part.cast("int")).mapInArrow(lay, _SLICE)


def _texts(data: bytes, sizes: list[int]) -> list[bytes]:
    whole, ends = zstandard.ZstdDecompressor().decompress(data), np.cumsum([0, *sizes]).tolist()
    return [whole[a:z] for a, z in zip(ends, ends[1:])]


# ---------------------------------------------------------------- counts

_REQUEST = "range int, slice long, part int, keys binary, n binary"
_ANSWER = "slice long, part int, range int, all_counts binary, fit_counts binary, stats array<long>"


def requests(slices: DataFrame, order: int, ranges: int) -> DataFrame:
    """Each slice's distinct n-grams and their frequencies, by range of keys."""
    import pyarrow as pa

    def ask(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                number, part, sizes, data = (batch.column(c)[row].as_py() for c in ("slice", "part", "n_texts", "texts"))
                tokens, start = token_hashes(_texts(data, sizes), order)
                keys, n = distinct_keys(ngram_keys(tokens, order), start)
                bounds = range_bounds(keys, ranges)
                own = [(r, a, z) for r, (a, z) in enumerate(zip(bounds, bounds[1:])) if a < z]
                columns = [
                    pa.array([r for r, _, _ in own], pa.int32()),
                    pa.array([number] * len(own), pa.int64()),
                    pa.array([part] * len(own), pa.int32()),
                    pa.array([pack_keys(keys[a:z]) for _, a, z in own], pa.binary()),
                    pa.array([pack_numbers(n[a:z]) for _, a, z in own], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["range", "slice", "part", "keys", "n"])

    return slices.select("slice", "part", "n_texts", "texts").mapInArrow(ask, _REQUEST)


def answers(asked: DataFrame) -> DataFrame:
    """Per slice and range the training counts of the slice's keys (left-out slices also get the counts without the left-out part),
    and per range a row without slice that holds tokens and distinct tokens of both."""
    import pyarrow as pa

    def answer(table: pa.Table) -> pa.Table:
        numbers, parts = table.column("slice").to_pylist(), table.column("part").to_pylist()
        keys = [unpack_keys(k.as_py()) for k in table.column("keys")]
        ends = np.cumsum([0, *map(len, keys)])
        known, where = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        counts = np.zeros((2, len(known)), np.int64)
        for i, part in enumerate(parts):
            if part != OTHER:
                at, n = where[ends[i] : ends[i + 1]], unpack_numbers(table.column("n")[i].as_py()).astype(np.int64)
                counts[0, at] += n
                if part == FIT:
                    counts[1, at] += n
        token = ((known & _TAG) == 1) & (known != ((_START & ~_TAG) | np.uint64(1)))
        stats = [int(x) for c in counts for x in (c[token].sum(), np.count_nonzero(c[token]))]
        given = []
        for i, part in enumerate(parts):
            at = where[ends[i] : ends[i + 1]]
            given.append((pack_numbers(counts[0, at]), pack_numbers(counts[1, at]) if part == LEFT_OUT else None))
        ranges = [table.column("range")[0].as_py()] * (len(parts) + 1)
        columns = {
            "slice": pa.array([*numbers, None], pa.int64()),
            "part": pa.array([*parts, None], pa.int32()),
            "range": pa.array(ranges, pa.int32()),
            "all_counts": pa.array([*(a for a, _ in given), None], pa.binary()),
            "fit_counts": pa.array([*(b for _, b in given), None], pa.binary()),
            "stats": pa.array([*([None] * len(parts)), stats], pa.list_(pa.int64())),
        }
        return pa.table(columns)

    return asked.groupBy("range").applyInArrow(answer, _ANSWER)


class Estimates:
    """Maximum-likelihood estimates of every token of a slice by order, and its bucket."""

    def __init__(self, data: bytes, sizes: list[int], given: list[bytes], order: int, n: int, vocabulary: int):
        tokens, start = token_hashes(_texts(data, sizes), order)
        keys = ngram_keys(tokens, order)
        known, _ = distinct_keys(keys, start)
        found = np.concatenate([unpack_numbers(g) for g in given]).astype(np.int64)
        size = np.diff(np.append(start, len(tokens)))
        place = np.arange(len(tokens)) - np.repeat(start, size)
        scored = np.flatnonzero(place >= order - 1)
        self.text = np.repeat(np.arange(len(size)), size)[scored]
        self.count = found[np.searchsorted(known, keys[0][scored])]
        self.shares = [np.full(len(scored), 1.0 / (vocabulary + 1)), self.count / max(n, 1)]
        level, context = np.full(len(scored), 1 if n else 0), np.ones(len(scored), np.int64)
        for k in range(2, order + 1):
            above = found[np.searchsorted(known, keys[k - 2][scored - 1])]
            own = found[np.searchsorted(known, keys[k - 1][scored])]
            self.shares.append(own / np.maximum(above, 1))
            level, context = np.where(above > 0, k, level), np.where(above > 0, above, context)
        self.bucket = level * 64 + np.log2(context).astype(np.int64)


# ---------------------------------------------------------------- weights

_EVENTS = "bucket binary, n binary, shares array<binary>"
_SUMS = "bucket int, k int, mass double"


def left_out_events(left_out: DataFrame, answered: DataFrame, order: int, n: int, vocabulary: int) -> DataFrame:
    """Estimates of the left-out tokens from the counts without them, equal ones counted."""
    import pyarrow as pa

    def events(table: pa.Table, given: pa.Table) -> pa.Table:
        own = given.sort_by("range").column("fit_counts").to_pylist()
        e = Estimates(table.column("texts")[0].as_py(), table.column("n_texts")[0].as_py(), own, order, n, vocabulary)
        with np.errstate(over="ignore"):
            same = e.bucket.astype(np.uint64)
            for share in e.shares:
                same = mix(same * _NEXT + share.view(np.uint64))
        _, at, times = np.unique(same, return_index=True, return_counts=True)
        shares = [pack_numbers(share[at].view(np.uint64)) for share in e.shares]
        return pa.table(
            {
                "bucket": pa.array([pack_numbers(e.bucket[at])], pa.binary()),
                "n": pa.array([pack_numbers(times)], pa.binary()),
                "shares": pa.array([shares], pa.list_(pa.binary())),
            }
        )

    return left_out.groupBy("slice").cogroup(answered.groupBy("slice")).applyInArrow(events, _EVENTS)


def learn_weights(events: DataFrame, order: int, tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights of each bucket (rows ``order of the longest context * 64 + log2 of its count``, columns uniform, 1, 2 ...).

    Each round is one pass over the events whose sums (buckets x estimates) come to the driver.  A part of a token is
    added to each estimate the bucket can use, so no weight is zero; buckets without events take the weights of the
    next smaller one of their order that has some, or the next larger, or equal weights.
    """
    import pyarrow as pa

    usable = np.arange(order + 1)[None, :] <= (np.arange((order + 1) * 64) // 64)[:, None]
    weights = usable / usable.sum(1, keepdims=True)
    last, seen = None, np.zeros(len(weights))

    def expect(current: np.ndarray):
        def run(batches):
            mass, likelihood = np.zeros(current.shape), 0.0
            for batch in batches:
                for row in range(batch.num_rows):
                    bucket = unpack_numbers(batch.column(0)[row].as_py()).astype(np.int64)
                    n = unpack_numbers(batch.column(1)[row].as_py()).astype(np.float64)
                    parts = [unpack_numbers(s).view(np.float64) * current[bucket, k] for k, s in enumerate(batch.column(2)[row].as_py())]
                    total = np.sum(parts, axis=0)
                    likelihood += float(n @ np.log(total))
                    for k, part in enumerate(parts):
                        mass[:, k] += np.bincount(bucket, n * part / total, len(mass))
            at, k = np.nonzero(mass)
            columns = [pa.array([*at, -1], pa.int32()), pa.array([*k, -1], pa.int32()), pa.array([*mass[at, k], likelihood])]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "k", "mass"])

        return run

    for _ in range(rounds):
        mass, likelihood = np.zeros(weights.shape), 0.0
        for bucket, k, m in events.mapInArrow(expect(weights), _SUMS).groupBy("bucket", "k").agg(F.sum("mass")).collect():
            if bucket < 0:
                likelihood = m
            else:
                mass[bucket, k] = m
        seen = mass.sum(1)
        mass = np.where(usable, mass + 1.0 / 16, 0.0)
        weights = mass / mass.sum(1, keepdims=True)
        if not seen.any() or (last is not None and likelihood - last < tolerance * seen.sum()):
            break
        last = likelihood
    else:
        warnings.warn(f"mixture weights still gained more than {tolerance} per token after {rounds} rounds")
    for level in range(order + 1):
        own = np.arange(level * 64, level * 64 + 64)
        full = own[seen[own] > 0]
        if len(full):
            weights[own] = weights[full[np.maximum(np.searchsorted(full, own, side="right") - 1, 0)]]
    return weights


# ---------------------------------------------------------------- scores

_SCORED = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(
    docs: DataFrame,
    training: Column,
    deleted: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = 2,
    slice_bytes: int = SLICE_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score``: one row per input row.

    ``training`` (a condition on a row) says which documents are learned from, ``deleted`` which of them are left out of
    the counts while the weights are learned; a null condition is false.  The scores then use the counts of all training documents.
    ``score`` is the log10 probability of the text's tokens and its end; the tokens of a text include the end.  ``base_score`` is that
    of add-one unigrams.  An unknown token has the probability of the one place kept for it.

    A null text is an empty one and has the end token only.  Ids may be null or repeat, repeated rows count each time.  A text of any
    length is scored whole; it and its n-grams must fit a task (about 100 bytes a token).  Without training documents
    every token is unknown.  An empty table gives no rows; other columns are ignored.
    """
    import pyarrow as pa

    part = F.when(~F.coalesce(training, F.lit(False)), OTHER).when(F.coalesce(deleted, F.lit(False)), LEFT_OUT).otherwise(FIT)
    slices = materialize(lay_slices(docs, part, id_col, text_col, slice_bytes))
    n_bytes = slices.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    answered = materialize(answers(requests(slices, order, max(8, -(-n_bytes // range_bytes)))))
    totals = answered.where("slice is null").select(*(F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(4))).first()
    n, vocabulary, fit_n, fit_vocabulary = map(int, totals)
    of_left_out = answered.where(F.col("part") == LEFT_OUT).select("slice", "range", "fit_counts")
    left_out = slices.where(F.col("part") == LEFT_OUT).select("slice", "n_texts", "texts")
    weights = learn_weights(materialize(left_out_events(left_out, of_left_out, order, fit_n, fit_vocabulary)), order)
    base = math.log10(n + vocabulary + 1)

    def score(table: pa.Table, given: pa.Table) -> pa.Table:
        own = given.sort_by("range").column("all_counts").to_pylist()
        ids, sizes, data = (table.column(c)[0].as_py() for c in ("doc_ids", "n_texts", "texts"))
        e = Estimates(data, sizes, own, order, n, vocabulary)
        chance = sum(weights[e.bucket, k] * share for k, share in enumerate(e.shares))
        sums = [np.bincount(e.text, w, len(ids)) for w in (None, e.count > 0, np.log10(e.count + 1.0) - base, np.log10(chance))]
        columns = {"doc_id": pa.array(ids, pa.int64())}
        for name, values in zip(("n_tokens", "n_known", "base_score", "score"), sums):
            columns[name] = pa.array(values, pa.int64() if name[:2] == "n_" else pa.float64(), safe=False)
        columns["train_tokens"] = pa.array([n] * len(ids), pa.int64())
        return pa.table({k.split()[0]: columns[k.split()[0]] for k in _SCORED.split(", ")})

    whole = slices.select("slice", "doc_ids", "n_texts", "texts")
    return whole.groupBy("slice").cogroup(answered.where("slice is not null").select("slice", "range", "all_counts").groupBy("slice")).applyInArrow(score, _SCORED)

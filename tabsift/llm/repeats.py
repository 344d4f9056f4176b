"""Removal of long repeated passages with a run-length index.

1. Anchors: of the 64-byte windows inside every 200-byte string, the one with the smallest hash is an anchor, so equal
   strings have equal anchors.  Anchor hashes are counted over the corpus; a string can only repeat if
   its anchor occurs twice.  Text around other anchors moves no further.
2. The text around a shared anchor (all 200-byte strings that contain it) is sent to the bucket of the anchor's
   owner, the smallest text id that has it: texts that share passages meet, and the pieces of one text merge.
3. In a bucket the run-length compressed Burrows-Wheeler transform is built with the text positions of its run ends
   sampled.  Longest matches with other places are computed at the samples only; streaming over the text,
   each next position's matching statistic is the last sample's less one per step.  Places with 200 or more repeat.
4. An owner with more text than a bucket holds is dealt over several buckets by text and position; each bucket passes
   on one place for each distinct string, and these are matched by 128-bit hash.  So nothing is capped and
   no task holds more than a bucket.
5. Before anchors or whole texts are joined, a filter of fixed size tells which rows can match; only those move, and the joins are exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import BATCH_CHARS, join_hot, map_texts, mark_maybe_in, maybe_in
from .rolling import sliding, window_hashes

LENGTH = 200
ANCHOR = 64

#: Anchors in a bucket (about 75 bytes of text each).
BUCKET_ANCHORS = 16_000
#: Positions of a text dealt together when its owner is dealt over several buckets: 2 ** BLOCK_BITS.
BLOCK_BITS = 18

_NO_ID = -(2**63)
_SECOND_TABLE = np.random.Generator(np.random.PCG64(4711)).integers(1, 2**63, 256, dtype=np.uint64)
_SECOND_MULT = np.uint64(0xD6E8FEB86659FD93)


# --- anchors ------------------------------------------------------------------------------------------------


def anchors(data: bytes, length: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors: windows of ``width`` bytes minimal in some string of ``length`` bytes."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spread = length - width + 1
    found, values = [], []
    step = BATCH_CHARS  # long texts in overlapping stretches
    for start in range(0, len(data) - length + 1, step):
        buf = np.frombuffer(data, np.uint8, min(len(data) - start, step + length - 1), start)
        h = window_hashes(buf, width)
        low = sliding(h, spread, np.minimum)
        rim = np.zeros(spread - 1, np.uint64)
        at = np.flatnonzero(sliding(np.concatenate([rim, low, rim]), spread, np.maximum) == h)
        found.append(at + start)
        values.append(h[at])
    at, h = np.concatenate(found), np.concatenate(values).view(np.int64)
    at, keep = np.unique(at, return_index=True)
    return at, h[keep]


def anchored(docs: DataFrame, id_col: str, text_col: str, length: int, width: int) -> DataFrame:
    """``doc_id, tag, text_key, n_bytes, hashes array<long>, places array<array<int>>``: per row the distinct anchor hashes
    and where they stand.  ``tag``, 8 bytes of the text's SHA-256, tells texts of a repeated (or null) id apart."""

    def fn(cols):
        out = {"doc_id": cols["doc_id"], "tag": [], "text_key": [], "n_bytes": [], "hashes": [], "places": []}
        for text in cols["text"]:
            data = (text or "").encode()
            at, h = anchors(data, length, width)
            order = np.argsort(h, kind="stable")
            cut = np.flatnonzero(np.diff(h[order])) + 1
            key = hashlib.sha256(data).digest()
            out["text_key"].append(key)
            out["tag"].append(int.from_bytes(key[:8], "big", signed=True))
            out["n_bytes"].append(len(data))
            out["hashes"].append(h[order[np.concatenate([[0], cut])]] if len(h) else [])
            out["places"].append([p.tolist() for p in np.split(at[order], cut)] if len(h) else [])
        return out

    view = docs.select(F.coalesce(F.col(id_col), F.lit(_NO_ID)).alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(view, fn, "doc_id long, tag long, text_key binary, n_bytes long, hashes array<long>, places array<array<int>>")


# --- the index of a bucket ----------------------------------------------------------------------------------


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffix array by prefix doubling from 8-byte keys; only suffixes not yet told apart are sorted again.  Also the keys, and
    the ranks of the prefixes of 8, 16, 32, ... bytes as far as some of them are equal."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    for k in range(8):
        keys = (keys << np.uint64(8)) | padded[k : k + n]
    sa = np.argsort(keys)
    head = np.concatenate([[True], np.diff(keys[sa]) != 0])
    place = np.arange(n)
    first = np.maximum.accumulate(np.where(head, place, 0))
    rank = np.empty(n, np.int64)
    rank[sa] = first
    done = 8
    active = np.flatnonzero(~(head & np.append(head[1:], True)))
    levels = []
    while len(active):
        levels.append(rank.astype(np.int32))
        pos = sa[active]
        follow = np.where(pos + done < n, rank[np.minimum(pos + done, n - 1)] + 1, 0)
        key = rank[pos] * np.int64(n + 1) + follow
        order = np.argsort(key, kind="stable")
        pos, key = pos[order], key[order]
        sa[active] = pos
        head = np.concatenate([[True], np.diff(key) != 0])
        rank[pos] = active[np.maximum.accumulate(np.where(head, np.arange(len(pos)), 0))]
        active = active[~(head & np.append(head[1:], True))]
        done *= 2
    return sa, keys, levels


def _common(keys: np.ndarray, levels: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at p and q (p != q): from the longest prefixes that are known to be equal
    down to eight bytes, then by the bytes of the keys, so the steps follow the logarithm of the length."""
    n = len(keys)
    out = np.zeros(len(p), np.int64)
    later = np.maximum(p, q)
    for k in range(len(levels) - 1, -1, -1):
        live = np.flatnonzero(later + out < n)
        same = levels[k][p[live] + out[live]] == levels[k][q[live] + out[live]]
        out[live[same]] += 8 << k
    live = np.flatnonzero(later + out < n)
    differ = keys[p[live] + out[live]] ^ keys[q[live] + out[live]]
    more, open_ = np.zeros(len(live), np.int64), np.ones(len(live), bool)
    for k in range(8):
        open_ &= (differ >> np.uint64(56 - 8 * k)) & np.uint64(255) == 0
        more += open_
    out[live] += more
    return np.minimum(out, n - later)


class RunIndex:
    """Run-length compressed Burrows-Wheeler transform of a byte string, with the text positions of its run ends."""

    def __init__(self, text: np.ndarray):
        self.text = text
        sa, keys, levels = suffix_array(text)
        bwt = np.where(sa > 0, text[sa - 1].astype(np.int16), np.int16(-1))
        starts = np.flatnonzero(np.diff(bwt, prepend=np.int16(-2)) != 0)
        ends = np.append(starts[1:], len(bwt)) - 1
        self.run_bytes, self.run_lengths = bwt[starts], ends - starts + 1
        self.first_sample, self.last_sample = sa[starts], sa[ends]
        before = np.where(starts > 0, sa[starts - 1], -1)
        after = np.where(ends + 1 < len(sa), sa[np.minimum(ends + 1, len(sa) - 1)], -1)
        self.first_match = self._matches(keys, levels, self.first_sample, before)
        self.last_match = self._matches(keys, levels, self.last_sample, after)

    @staticmethod
    def _matches(keys, levels, p, q):
        out = np.zeros(len(p), np.int64)
        real = q >= 0
        out[real] = _common(keys, levels, p[real], q[real])
        return out

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For each position, in one stream over the text: the longest match with the lexicographically previous and with
        the next place.  Within a run both places step along together, so a statistic is the last sample's less the distance."""
        return self._stream(self.first_sample, self.first_match), self._stream(self.last_sample, self.last_match)

    def _stream(self, samples, matches):
        reach = np.full(len(self.text), -1, np.int64)
        reach[samples] = samples + matches
        at = np.maximum.accumulate(np.where(reach >= 0, np.arange(len(reach)), 0))
        return np.maximum(reach[at] - np.arange(len(reach)), 0)


SEPARATOR = 0xFF  # in no UTF-8 text, so no match of two texts' strings holds it


def scan_bucket(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pieces laid end to end with separators; where pieces start; for each place whether its string of ``length`` bytes
    is whole and stands elsewhere in the bucket; and whether it is the one place listed for its string."""
    offsets = np.cumsum([0] + [len(p) + 1 for p in pieces])
    text = np.frombuffer(b"\xff".join([*pieces, b""]), np.uint8)
    up, down = RunIndex(text).matching_statistics()
    whole = np.zeros(len(text), bool)
    for start, piece in zip(offsets, pieces):
        whole[start : start + max(0, len(piece) - length + 1)] = True
    repeated = whole & ((up >= length) | (down >= length))
    return text, offsets, repeated, whole & (up < length)


def _runs(starts: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """Union of [s, s + length) over ascending starts."""
    if not len(starts):
        return [], []
    gap = np.flatnonzero(np.diff(starts) > length)
    return starts[np.append(0, gap + 1)].tolist(), (starts[np.append(gap, len(starts) - 1)] + length).tolist()


MARKS = "doc_id long, tag long, starts array<int>, ends array<int>, owner long, part int, hashes binary, places binary"


def _mark_rows(rows: list[dict]):
    import pyarrow as pa

    kinds = {"doc_id": pa.int64(), "tag": pa.int64(), "starts": pa.list_(pa.int32()), "ends": pa.list_(pa.int32()), "owner": pa.int64(), "part": pa.int32(), "hashes": pa.binary(), "places": pa.binary()}
    return pa.table({k: pa.array([r.get(k) for r in rows], t) for k, t in kinds.items()})


def index_bucket(length: int):
    """One bucket's table (bucket, owner, salts, doc_id, start, piece) -> marks of repeated stretches, and, in a bucket
    that shares its owner with others, one place of each distinct string for :func:`match_across`."""

    def fn(table):
        pieces = {}
        for doc, tag, start, piece in zip(*(table.column(c).to_pylist() for c in ("doc_id", "tag", "start", "piece"))):
            pieces[(doc, tag, start)] = piece  # a row of the input that repeats sends its pieces twice
        keys = sorted(pieces)
        text, offsets, repeated, listed = scan_bucket([pieces[k] for k in keys], length)
        names = np.array([k[:2] for k in keys], np.int64)
        shift = np.array([k[2] for k in keys], np.int64) - offsets[:-1]
        out = []
        for i, (doc, tag, _) in enumerate(keys):
            starts, ends = _runs(np.flatnonzero(repeated[offsets[i] : offsets[i + 1]]) + offsets[i] + shift[i], length)
            if starts:
                out.append({"doc_id": doc, "tag": tag, "starts": starts, "ends": ends})
        salts = table.column("salts")[0].as_py()
        if salts > 1:
            at = np.flatnonzero(listed)
            piece = np.searchsorted(offsets, at, side="right") - 1
            one = window_hashes(text, length)[at]
            two = window_hashes(text, length, _SECOND_TABLE, _SECOND_MULT)[at]
            place = np.column_stack([names[piece], at + shift[piece], repeated[at]]).astype("<i8")
            part = (one % np.uint64(salts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(salts + 1))
            both = np.stack([one, two], axis=1)
            for k in range(salts):
                own = order[cuts[k] : cuts[k + 1]]
                if len(own):
                    out.append({"owner": table.column("owner")[0].as_py(), "part": k, "hashes": both[own].tobytes(), "places": place[own].tobytes()})
        return _mark_rows(out)

    return fn


def match_across(length: int):
    """Strings listed by several buckets of an owner: marks for the places not marked by their own bucket."""

    def fn(table):
        hashes = np.frombuffer(b"".join(table.column("hashes").to_pylist()), "<u8").reshape(-1, 2)
        places = np.frombuffer(b"".join(table.column("places").to_pylist()), "<i8").reshape(-1, 4)
        order = np.lexsort((places[:, 2], places[:, 1], places[:, 0], hashes[:, 1], hashes[:, 0]))
        hashes, places = hashes[order], places[order]
        same_string = (np.diff(hashes, axis=0) == 0).all(1)
        same_place = np.append(False, same_string & (np.diff(places[:, :3], axis=0) == 0).all(1))
        hashes, places = hashes[~same_place], places[~same_place]  # two buckets may list one place
        same_string = (np.diff(hashes, axis=0) == 0).all(1)
        hit = places[np.append(same_string, False) | np.append(False, same_string)]
        hit = hit[hit[:, 3] == 0]
        hit = hit[np.lexsort((hit[:, 2], hit[:, 1], hit[:, 0]))]
        out = []
        for part in np.split(hit, np.flatnonzero(np.diff(hit[:, :2], axis=0).any(1)) + 1):
            if len(part):
                starts, ends = _runs(part[:, 2], length)
                out.append({"doc_id": int(part[0, 0]), "tag": int(part[0, 1]), "starts": starts, "ends": ends})
        return _mark_rows(out)

    return fn


# --- the corpus ---------------------------------------------------------------------------------------------


def repeated_marks(docs: DataFrame, found: DataFrame, classes: DataFrame, id_col: str, text_col: str, length: int, width: int) -> DataFrame:
    """``doc_id, tag, starts array<array<int>>, ends array<array<int>>``: stretches of one representative of each distinct text."""
    uses = representatives(found, classes).select("doc_id", "tag", F.explode(F.arrays_zip("hashes", "places")).alias("a")).select(
        "doc_id", "tag", F.col("a.hashes").alias("hash"), F.col("a.places").alias("places")
    )
    counts = (
        uses.groupBy("hash")
        .agg(F.sum(F.size("places")).alias("n"), F.min("doc_id").alias("owner"), F.count("*").alias("rows"))
        .where(F.col("n") > 1)
    )
    counts = materialize(counts)
    owners = counts.groupBy("owner").agg(F.ceil(F.sum("n") / BUCKET_ANCHORS).cast("int").alias("salts"))
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    buckets = max(1, -(-sums[0] // BUCKET_ANCHORS))
    of_hash = counts.join(owners, "owner").select("hash", "owner", "salts", "rows")
    shared = join_hot(maybe_in(uses, counts, "hash"), of_hash, "hash", "rows", sums[1])
    per_text = shared.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("owner", "salts", "places")).alias("shared"))
    per_text = materialize(per_text.join(_named(classes), ["doc_id", "tag"]))
    texts = maybe_in(_texts(docs, id_col, text_col), per_text, "text_key")
    pieces = map_texts(
        texts.join(per_text, ["doc_id", "tag", "text_key"]).select("doc_id", "tag", "text", "shared"),
        _cut_pieces(buckets, length, width),
        "bucket long, owner long, salts int, doc_id long, tag long, start int, piece binary",
    )
    marks = materialize(pieces.groupBy("bucket").applyInArrow(index_bucket(length), MARKS))
    across = marks.where(F.col("owner").isNotNull()).groupBy("owner", "part").applyInArrow(match_across(length), MARKS)
    return (
        marks.where(F.col("owner").isNull())
        .unionByName(across)
        .groupBy("doc_id", "tag")
        .agg(F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"))
    )


def representatives(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of ``found`` that have the smallest id of their text.  A row whose text is surely there once is one, and stays where it is."""
    told = mark_maybe_in(found, classes.where(F.col("copies") > 1), "text_key", "copied")
    low = classes.select(F.col("low").alias("doc_id"), "text_key")
    return told.where(~F.col("copied")).unionByName(told.where("copied").join(low, ["doc_id", "text_key"], "left_semi")).drop("copied")


def _named(classes: DataFrame) -> DataFrame:
    """``doc_id, tag, text_key`` of the representative of each distinct text."""
    return classes.select(F.col("low").alias("doc_id"), _tag(F.hex("text_key")).alias("tag"), "text_key")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    key = F.sha2(F.col(text_col), 256)
    return docs.select(
        F.coalesce(F.col(id_col), F.lit(_NO_ID)).alias("doc_id"),
        F.unhex(key).alias("text_key"),
        _tag(key).alias("tag"),
        F.col(text_col).alias("text"),
    ).where(F.col("text").isNotNull())


def _tag(key_hex: Column) -> Column:
    """The first 8 bytes of a hex digest as a signed long."""
    high, low = (F.conv(F.substring(key_hex, k, 8), 16, 10).cast("long") for k in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def _cut_pieces(buckets: int, length: int, width: int):
    import xxhash

    def fn(cols):
        out = {k: [] for k in ("bucket", "owner", "salts", "doc_id", "tag", "start", "piece")}
        for doc, tag, text, shared in zip(cols["doc_id"], cols["tag"], cols["text"], cols["shared"]):
            data = text.encode()
            by_bucket: dict[tuple, list[int]] = {}
            for s in shared:
                if s["salts"] == 1:
                    key = (xxhash.xxh3_64_intdigest(s["owner"].to_bytes(8, "little", signed=True)) % buckets, s["owner"], 1)
                    by_bucket.setdefault((key[0], None, 1), []).extend(s["places"])
                    continue
                for p in s["places"]:
                    name = f"{s['owner']}:{xxhash.xxh3_64_intdigest(f'{doc}:{p >> BLOCK_BITS}') % s['salts']}"
                    by_bucket.setdefault((-1 - (xxhash.xxh3_64_intdigest(name) >> 1), s["owner"], s["salts"]), []).append(p)
            for (bucket, owner, salts), places in by_bucket.items():
                at = np.unique(np.array(places, np.int64))
                first, last = np.maximum(at + width - length, 0), np.minimum(at + length, len(data))
                cut = np.flatnonzero(first[1:] > last[:-1]) + 1
                for a, b in zip(first[np.append(0, cut)].tolist(), last[np.append(cut - 1, len(at) - 1)].tolist()):
                    for k, v in zip(out, (bucket, owner, salts, doc, tag, a, data[a:b])):
                        out[k].append(v)
        return out

    return fn


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_kept: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans array<struct<first,last>>`` (and ``kept binary``); one row per input row.

    A byte goes if a ``length``-byte string that covers it also starts anywhere else in the corpus, same text
    included (overlaps count; all strings are judged on the input).  Texts are UTF-8 bytes, null is empty, and matches never
    cross texts.  Of equal texts of at least ``length`` bytes every byte repeats, so one of them stands for
    all in the index.  Spans are half-open byte ranges; cuts may fall inside a character, hence ``kept`` is
    binary.  Repeated rows are equal texts.  Null ids are allowed; other columns are ignored; an empty table gives no rows.
    """
    width = min(ANCHOR, max(1, length // 2))
    found = materialize(anchored(docs, id_col, text_col, length, width))
    classes = materialize(found.groupBy("text_key").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies")))
    total = classes.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    marks = repeated_marks(docs, found, classes, id_col, text_col, length, width)
    marks = materialize(marks.join(_named(classes.where(F.col("copies") == 1)), ["doc_id", "tag"]))
    texts = maybe_in(_texts(docs, id_col, text_col), marks, "text_key")
    marked = map_texts(
        texts.join(marks, ["doc_id", "tag", "text_key"]),
        _cut_out,
        "doc_id long, text_key binary, n_removed long, spans array<struct<first: int, last: int>>, cut_sha256 string"
        + ", kept binary" * with_kept,
    )
    copied = classes.where(F.col("copies") > 1).select("text_key", F.lit(True).alias("copied"), "copies")
    base = join_hot(found.select("doc_id", "text_key", "n_bytes"), copied, "text_key", "copies", total, "left")
    gone = F.coalesce("copied", F.lit(False)) & (F.col("n_bytes") >= length)
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n_bytes").cast("int").alias("last")))
    none = F.array().cast("array<struct<first: int, last: int>>")
    out = base.join(marked, ["doc_id", "text_key"], "left").select(
        F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias("doc_id"),
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("cut_sha256", F.lower(F.hex("text_key")))).alias("kept_sha256"),
        *([F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if with_kept else []),
    )
    if with_kept:
        raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
        raw = docs.select(raw.alias("raw"), F.lower(F.sha2(raw, 256)).alias("kept_sha256")).distinct()
        out = out.join(raw, "kept_sha256", "left").withColumn("kept", F.coalesce("kept", "raw")).drop("raw")
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "spans", *(["kept"] if with_kept else []))


def _cut_out(cols):
    out = {"doc_id": cols["doc_id"], "text_key": cols["text_key"], "n_removed": [], "spans": [], "cut_sha256": [], "kept": []}
    for text, starts, ends in zip(cols["text"], cols["starts"], cols["ends"]):
        data = text.encode()
        spans: list[list[int]] = []
        for a, b in sorted((a, b) for s, e in zip(starts, ends) for a, b in zip(s, e)):
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(b, spans[-1][1])
            else:
                spans.append([a, b])
        kept, at = [], 0
        for a, b in spans:
            kept.append(data[at:a])
            at = b
        kept = b"".join([*kept, data[at:]])
        out["n_removed"].append(len(data) - len(kept))
        out["spans"].append([{"first": a, "last": b} for a, b in spans])
        out["cut_sha256"].append(hashlib.sha256(kept).hexdigest())
        out["kept"].append(kept)
    return out

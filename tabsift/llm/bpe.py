"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

Texts are cut at rolling-hash boundaries.  Each distinct chunk of the corpus is encoded once: a chunk of one text only
with that text, a chunk that several texts share with the one that owns it, whose ids are sent to the others.
Only recipes (chunk digests), one compressed copy of each distinct text and the ids of shared chunks and of the texts that
wait for them are moved.  A chunk cut in mid-word tokenises wrongly at its rims, so every join is repaired: the text between the last safe cut before the join and the first
one after it is encoded anew; where a chunk has no safe cut the window grows over it and the next, up to the
whole text.  A safe cut is a place between a non-space and an ASCII space.  The pre-tokeniser never
matches across such a place and never looks past it, so ids on either side are independent and the repaired ids
agree exactly with those of the whole text.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import join_hot, map_texts
from .rolling import chunk_ends

AVERAGE, SMALLEST, LARGEST = 2048, 512, 16384

#: Pieces whose ids a worker remembers; the memory is emptied when full (about 100 MB).
REMEMBERED = 300_000

# Fixed value: the pre-tokenisation pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NO_ID = -(2**63)
_DOUBLE_SPACE = re.compile(r"\s ")
_SAFE_CUT = re.compile(r"(?<=\S)(?= )")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """Inverse of the byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256, 257, ..."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Coder(dict):
    """Encoder and decoder of one vocabulary file; as a dict, remembers the ids (little-endian uint32) of pieces."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        size = max([*ranks.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in ranks.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.lengths = np.array([len(b) for b in self.bytes_of])

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        # the two libraries may hold different Unicode versions; in this range their letters are the same
        if max(piece, default=" ") < "ɐ":
            ids = self.fast.encode(piece, allowed_special="all") if "<|" in piece else self.fast.encode_ordinary(piece)
        else:
            ids = self.library.encode(piece, add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        if len(piece) < 64:
            self[piece] = packed
        return packed

    def pieces(self, text: str) -> list[str]:
        """Text cut at all its safe places; any piece but the first begins with a space."""
        if _DOUBLE_SPACE.search(text) or text.startswith(" "):
            return _SAFE_CUT.split(text)
        first, *more = text.split(" ")
        return [first, *(" " + x for x in more)]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, self.pieces(text))), "<u4")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        """As the library's ``decode(ids, skip_special_tokens=False)``: bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def encode_chunk(self, text: str) -> tuple[np.ndarray, int, int]:
        """Ids of a chunk on its own, and the id offsets of its first and last safe cut (-1, -1: it has none)."""
        packed = list(map(self.__getitem__, self.pieces(text)))
        ids = np.frombuffer(b"".join(packed), "<u4")
        return (ids, len(packed[0]) // 4, len(ids) - len(packed[-1]) // 4) if len(packed) > 1 else (ids, -1, -1)

    def join(self, chunks: list[tuple[np.ndarray, int, int]]) -> np.ndarray:
        """Ids of the whole text from those of its chunks, each join repaired."""
        out, open_ids = [], []
        for ids, first, last in chunks:
            if first < 0:
                open_ids.append(ids)
                continue
            out.append(self._again([*open_ids, ids[:first]]))
            out.append(ids[first:last])
            open_ids = [ids[last:]]
        out.append(self._again(open_ids))
        return np.concatenate(out)

    def _again(self, parts: list[np.ndarray]) -> np.ndarray:
        return self.encode(b"".join(map(self.decode_bytes, parts)).decode())


_CODERS: dict[str, Coder] = {}


def coder(path: str | None = None) -> Coder:
    """The worker's coder for a vocabulary file, loaded once."""
    path = path or default_vocabulary()
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def _cut(text: str | None):
    data = (text or "").encode()
    start = 0
    for end in chunk_ends(data, AVERAGE, SMALLEST, LARGEST):
        yield xxhash.xxh3_128_digest(data[start:end]), data[start:end]
        start = end


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, tag long, text_key binary, n_bytes, chunks array<binary>``: the ordered chunk digests of each row.
    ``text_key`` sums them up; ``tag`` tells the texts of a repeated or null id apart."""

    def fn(cols):
        out = {"doc_id": cols["doc_id"], "tag": cols["tag"], "text_key": [], "n_bytes": [], "chunks": []}
        for text in cols["text"]:
            keys, n = [], 0
            for key, chunk in _cut(text):
                keys.append(key)
                n += len(chunk)
            out["chunks"].append(keys)
            out["n_bytes"].append(n)
            out["text_key"].append(hashlib.sha256(b"".join(keys)).digest())
        return out

    return map_texts(_tagged(docs, id_col, text_col), fn, "doc_id long, tag long, text_key binary, n_bytes long, chunks array<binary>")


def _tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col), F.lit(_NO_ID)).alias("doc_id"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text"))


def _compressed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, tag, body``: texts compressed for the shuffle."""

    def fn(cols):
        press = zstandard.ZstdCompressor(level=3).compress
        return {"doc_id": cols["doc_id"], "tag": cols["tag"], "body": [press((t or "").encode()) for t in cols["text"]]}

    return map_texts(_tagged(docs, id_col, text_col), fn, "doc_id long, tag long, body binary")


def pack_ids(ids: np.ndarray, vocabulary_size: int) -> bytes:
    return ids.astype("<u2" if vocabulary_size <= 65536 else "<u4").tobytes()


def unpack_ids(data: bytes, vocabulary_size: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if vocabulary_size <= 65536 else "<u4").astype("<u4")


#: What a text's own task returns: a finished text, the parts of a text that waits for shared chunks, or an owned shared chunk.
_DONE, _PART, _SHARED = 0, 1, 2
_RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"
_EXTRA = {"ids": "ids binary", "decoded": "decoded string"}


def _finish(tool: Coder, ids: np.ndarray, outputs: tuple[str, ...]) -> dict:
    raw, text = ids.tobytes(), tool.decode(ids)
    row = {"n_tokens": len(ids), "ids_sha256": hashlib.sha256(raw).hexdigest(), "decoded_sha256": hashlib.sha256(text.encode()).hexdigest()}
    return row | {n: {"ids": raw, "decoded": text}[n] for n in outputs}


def _encode_own(vocabulary: str | None, outputs: tuple[str, ...]):
    """Per text: encode all chunks but those another text owns."""

    def fn(cols):
        tool = coder(vocabulary)
        unpack, press = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=3).compress
        names = ["kind", "text_key", "seq", "chunk", "packed", "first", "last", "n_tokens", "ids_sha256", "decoded_sha256", *outputs]
        out: dict[str, list] = {n: [] for n in names}

        def add(**cells):
            for n in names:
                out[n].append(cells.get(n))

        for key, body, foreign, owned in zip(cols["text_key"], cols["body"], cols["foreign"], cols["owned"]):
            skip, lend = set(foreign or ()), set(owned or ())
            parts, memory = [], {}
            for seq, (chunk, data) in enumerate(_cut(unpack(body).decode())):
                if seq in skip:
                    continue
                if chunk not in memory:
                    memory[chunk] = tool.encode_chunk(data.decode())
                    if seq in lend:
                        ids, first, last = memory[chunk]
                        add(kind=_SHARED, chunk=chunk, packed=press(pack_ids(ids, len(tool.bytes_of))), first=first, last=last)
                parts.append((seq, *memory[chunk]))
            if not skip:
                add(kind=_DONE, text_key=key, **_finish(tool, tool.join([p[1:] for p in parts]), outputs))
            for seq, ids, first, last in parts if skip else ():
                add(kind=_PART, text_key=key, seq=seq, packed=press(pack_ids(ids, len(tool.bytes_of))), first=first, last=last)
        return out

    return fn


def _assemble(vocabulary: str | None, outputs: tuple[str, ...]):
    """Per text that waited: join its parts and the shared chunks."""

    def fn(cols):
        tool, unpack = coder(vocabulary), zstandard.ZstdDecompressor().decompress
        for key, parts in zip(cols["text_key"], cols["parts"]):
            row = sorted(parts, key=lambda p: p["seq"])
            ids = tool.join([(unpack_ids(unpack(p["packed"]), len(tool.bytes_of)), p["first"], p["last"]) for p in row])
            yield {"text_key": key} | _finish(tool, ids, outputs)

    return fn


def encode_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, outputs: tuple[str, ...] = ("ids", "decoded")
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes`` and the ``outputs`` asked for, of ``ids binary`` (little-endian
    unsigned 32-bit) and ``decoded string``; one row per input row.

    Ids are those of the tokenizers library with ``add_special_tokens=False`` (the special token's own string
    in a text becomes its id); ``decoded`` is the library's decode of them.  Null is the empty text: no ids.
    Each distinct text is put together once, whatever the number of its copies.  Repeated rows and ids repeat in
    the result, null ids are allowed; an empty table gives no rows; other columns are ignored.
    """
    listed = materialize(recipes(docs, id_col, text_col))
    texts = materialize(
        listed.groupBy("text_key").agg(F.count("*").alias("rows"), F.min(F.struct("doc_id", "tag")).alias("from"), F.max("chunks").alias("chunks"))
    )
    total = texts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    uses = texts.select("text_key", F.posexplode("chunks").alias("seq", "chunk"))
    shared = materialize(
        uses.groupBy("chunk").agg(F.count("*").alias("uses"), F.min("text_key").alias("owner"), F.max("text_key").alias("other")).where(F.col("owner") != F.col("other"))
    )
    n_uses = shared.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]
    tied = materialize(join_hot(uses, shared.select("chunk", "owner", "uses"), "chunk", "uses", n_uses))
    mine = F.col("text_key") == F.col("owner")
    ties = tied.groupBy("text_key").agg(
        F.collect_list(F.when(~mine, F.col("seq"))).alias("foreign"), F.collect_list(F.when(mine, F.col("seq"))).alias("owned")
    )
    info = texts.select("text_key", F.col("from.doc_id").alias("doc_id"), F.col("from.tag").alias("tag")).join(ties, "text_key", "left")
    once = _compressed(docs, id_col, text_col).join(info, ["doc_id", "tag"]).select("text_key", "body", "foreign", "owned")
    extra = "".join(f", {_EXTRA[n]}" for n in outputs)
    schema = f"kind int, text_key binary, seq int, chunk binary, packed binary, first int, last int, {_RESULT}{extra}"
    made = materialize(map_texts(once, _encode_own(vocabulary, outputs), schema, text="body"))
    result = ["text_key", "n_tokens", "ids_sha256", "decoded_sha256", *outputs]
    lent = made.where(F.col("kind") == _SHARED).dropDuplicates(["chunk"]).select("chunk", "packed", "first", "last")
    sized = lent.join(shared.select("chunk", "uses"), "chunk")
    borrowed = join_hot(tied.where(~mine).select("text_key", "seq", "chunk"), sized, "chunk", "uses", n_uses)
    piece = F.struct("seq", "first", "last", "packed")
    waiting = (
        made.where(F.col("kind") == _PART).select("text_key", piece.alias("p")).unionByName(borrowed.select("text_key", piece.alias("p")))
        .distinct()  # a row of the input that repeats gives its parts twice
        .groupBy("text_key").agg(F.collect_list("p").alias("parts"))
    )
    late = waiting.mapInArrow(_rows_of(_assemble(vocabulary, outputs), f"text_key binary, {_RESULT}{extra}"), f"text_key binary, {_RESULT}{extra}")
    done = made.where(F.col("kind") == _DONE).select(*result).dropDuplicates(["text_key"]).unionByName(late.select(*result))
    members = listed.select(F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias("doc_id"), "text_key", "n_bytes")
    if outputs:  # a text with its ids may be long, so nothing is broadcast here, and they are not written once more
        coded = members.join(done, "text_key", "left")
    else:
        done = materialize(done)
        coded = join_hot(members, done.join(texts.select("text_key", "rows"), "text_key"), "text_key", "rows", total)
    return coded.select("doc_id", *result[1:], "n_bytes")


def _rows_of(fn, schema: str):
    """``fn`` over one row at a time (a row holds a whole text's parts); results leave in batches of up to 256 rows or 8 MB."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                for row in fn({n: one.column(k).to_pylist() for k, n in enumerate(one.schema.names)}):
                    rows.append(row)
                    size += 8 * row["n_tokens"]
                if len(rows) >= 256 or size > 8_000_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return run

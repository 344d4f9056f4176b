"""Token-id packing: best-fit-decreasing with a segment tree over free capacities.

Documents are dealt by hash into blocks of bounded size (their number grows with the corpus); each block
is one task's work: encode, split documents longer than a row without loss, and pack the pieces into rows
of ``capacity`` ids.  Nothing but the text moves, once; a lost block is packed again with the same result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import coder

CAPACITY = 2048
#: Characters of text in a block, on average.
BLOCK_CHARS = 4_000_000

PACKED = (
    "pack_id long, n_tokens int, n_segments int, doc_ids array<long>, piece_starts array<int>, "
    "cu_seqlens array<int>, position_resets array<int>, ids binary, ids_sha256 string"
)


class FreeSpace:
    """Open bins by free capacity: a segment tree that finds the smallest capacity of at least n that some bin has."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.full = [False] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, free: int, which: int) -> None:
        self.bins[free].append(which)
        i = free + self.size
        while i and not self.full[i]:
            self.full[i] = True
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The (free capacity, bin) that fits best, taken out; None if no bin has room."""
        i = need + self.size
        if not self.full[i]:
            while i > 1 and not (i & 1 == 0 and self.full[i + 1]):  # up to the first non-empty subtree on the right
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.full[2 * i] else 2 * i + 1
        free = i - self.size
        which = self.bins[free].pop()
        if not self.bins[free]:
            self.full[i] = False
            i >>= 1
            while i:
                self.full[i] = self.full[2 * i] or self.full[2 * i + 1]
                i >>= 1
        return free, which


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items (by index) of each bin; items come longest first, ties in the given order, empty items nowhere."""
    space, bins = FreeSpace(capacity), []
    for item in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        if not (n := lengths[item]):
            break
        free, which = space.take(n) or (capacity, len(bins))
        if which == len(bins):
            bins.append([])
        bins[which].append(item)
        if free > n:
            space.add(free - n, which)
    return bins


def pack_block(block: int, doc_ids: list, encoded: list[np.ndarray], capacity: int, pad: int, dtype: str):
    """Rows of one block; ``encoded`` in the order of ``doc_ids``."""
    pieces = [(d, s, ids[s : s + capacity]) for d, ids in zip(doc_ids, encoded) for s in range(0, len(ids), capacity)]
    for number, items in enumerate(best_fit_decreasing([len(p[2]) for p in pieces], capacity)):
        row = [pieces[i] for i in items]
        cu = np.cumsum([0] + [len(p[2]) for p in row])
        ids = np.full(capacity, pad, dtype)
        ids[: cu[-1]] = np.concatenate([p[2] for p in row])
        raw = ids.tobytes()
        yield {
            "pack_id": (block << 32) + number,
            "n_tokens": int(cu[-1]),
            "n_segments": len(row),
            "doc_ids": [p[0] for p in row],
            "piece_starts": [p[1] for p in row],
            "cu_seqlens": cu.tolist(),
            "position_resets": cu[:-1].tolist(),
            "ids": raw,
            "ids_sha256": hashlib.sha256(raw).hexdigest(),
        }


def pack_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    block_chars: int = BLOCK_CHARS,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per packed row: ``pack_id``, its ids as little-endian unsigned 16-bit integers (32-bit for vocabularies
    over 65,536) padded to ``capacity`` with the first special id, the documents of its segments, where each
    segment starts in its document, cumulative segment lengths, and the places where positions restart at 0.

    Every token of every document is in exactly one row, so joining a document's segments by
    ``piece_starts`` gives its ids back.  Null and empty texts have no ids and are in no row.  Ties are
    broken by id, then text; repeated rows are packed as often as they occur.  A null id stays null in
    ``doc_ids``.  An empty table gives no rows; other columns are ignored.
    """
    import pyarrow as pa

    view = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text") != "")
    chars = view.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    arrow = {f: t for f, t in (("pack_id", pa.int64()), ("n_tokens", pa.int32()), ("n_segments", pa.int32()))}
    arrow |= {"doc_ids": pa.list_(pa.int64())} | {k: pa.list_(pa.int32()) for k in ("piece_starts", "cu_seqlens", "position_resets")}
    arrow |= {"ids": pa.binary(), "ids_sha256": pa.string()}

    def pack(table: pa.Table) -> pa.Table:
        tool = coder(vocabulary)
        block = table.column("block")[0].as_py()
        rows = table.select(["doc_id", "text"]).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        encoded = [tool.encode(t.as_py()) for t in rows.column("text")]
        size = len(tool.bytes_of)
        pad = next(iter(tool.special.values()), 0)
        out = list(pack_block(block, rows.column("doc_id").to_pylist(), encoded, capacity, pad, "<u2" if size <= 65536 else "<u4"))
        return pa.table({k: pa.array([r[k] for r in out], t) for k, t in arrow.items()})

    dealt = view.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(pack, PACKED)

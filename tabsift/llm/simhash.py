"""SimHash near-dedup by anchor-point covering.

The anchors are the codewords of the perfect [63, 57] Hamming code (covering radius 1) on the lower 63 bits of a
fingerprint; bit 63 is left out, which can only lower a distance.  Each fingerprint is replicated to
every anchor near it and fingerprints are compared at their anchors.

Radius: two fingerprints x, y that differ in t bits have a middle z within ceil(t/2) of both, and z has an
anchor within the covering radius 1.  As all fingerprints are replicated (not one side of a join only), the ball of
covering radius plus threshold that finds y around x may be shared out between the two: with
1 + ceil(t/2) on either side, x and y meet at z's anchor.  For t = 2 that is radius 2: one or 32 anchors per
fingerprint instead of 652, with the same pairs found.  ``radius`` can be raised to the full 1 + t.
"""

from __future__ import annotations

import itertools

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import join_hot, map_texts
from .components import connected_components

SEED = 42


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, fp long``: the 64-bit SimHash of each whole text, as a signed long.

    Lower-cases A-Z, takes maximal runs of bytes other than space and 0x09-0x0D as words and every run of
    ``shingle`` words (repeats included, space-joined; fewer words: the whole sequence).  A bit is 1 if it is
    set in over half the XXH64 (seed 42) hashes.  No word or null: 0.
    """

    def fn(cols):
        return {"doc_id": cols["doc_id"], "fp": [simhash(t, shingle) for t in cols["text"]]}

    return map_texts(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), fn, "doc_id long, fp long"
    )


def simhash(text: str | None, shingle: int) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    votes = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):
        part = words[start : min(n, start + (1 << 16)) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def syndrome_masks(radius: int) -> list[np.ndarray]:
    """For each syndrome s, the flips of at most ``radius`` of the lower 63 bits that lead to a codeword.

    Bit i - 1 stands for position i = 1..63 and a word's syndrome is the xor of its set positions, so
    the flips are the position sets whose xor is s.
    """
    by_syndrome: list[list[int]] = [[] for _ in range(64)]
    for k in range(radius + 1):
        for spots in itertools.combinations(range(1, 64), k):
            s = mask = 0
            for i in spots:
                s ^= i
                mask |= 1 << (i - 1)
            by_syndrome[s].append(mask)
    return [np.array(m, np.uint64) for m in by_syndrome]


_POSITION_BITS = [np.uint64(sum(1 << (i - 1) for i in range(1, 64) if i >> k & 1)) for k in range(6)]


def anchors_of(fps: np.ndarray, masks: list[np.ndarray]) -> list[np.ndarray]:
    low = fps.view(np.uint64) & np.uint64(2**63 - 1)
    s = np.zeros(len(low), np.int64)
    for k, m in enumerate(_POSITION_BITS):
        s |= (np.bitwise_count(low & m).astype(np.int64) & 1) << k
    return [(low[i] ^ masks[s[i]]).view(np.int64) for i in range(len(low))]


def near_links(fps: DataFrame, max_bits: int = 2, radius: int | None = None) -> DataFrame:
    """``a, b``: links that connect all fingerprints of ``fps(fp)`` differing in at most ``max_bits`` bits.

    Fingerprints compared at an anchor all lie within ``radius`` of it, so at most 4,034 distinct ones (radius 2)
    meet there however many rows there are.  They are compared block-wise and only a spanning set of links
    is returned; every linked pair is connected through it.
    """
    radius = 1 + (max_bits + 1) // 2 if radius is None else radius
    masks = syndrome_masks(radius)

    def replicate(batches):
        import pyarrow as pa

        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            lists = anchors_of(fp, masks)
            sizes = [len(x) for x in lists]
            flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat), pa.array(np.repeat(fp, sizes))], names=["anchor", "fp"]
            )

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = [], []
            for members in batch.column(0).to_pylist():
                own = np.sort(np.array(members, np.int64))
                for x, y in _spanning(own, max_bits):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    placed = fps.select("fp").distinct().mapInArrow(replicate, "anchor long, fp long")
    met = placed.groupBy("anchor").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")
    return met.mapInArrow(compare, "a long, b long").distinct()


def _spanning(own: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links along a breadth-first search of the graph of fingerprints within ``max_bits`` bits."""
    links, left = [], own
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count((left ^ x).view(np.uint64)) <= max_bits
            for y in left[near]:
                links.append((int(x), int(y)))
                front.append(y)
            left = left[~near]
    return links


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """``doc_id, fp long, fingerprint string, component_id``; one row per input row.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id`` is the smallest id
    reachable by links.  Null and empty texts have fingerprint 0 and link like any other.  Rows with equal
    fingerprints are one node whatever their number.  Null ids take part; a component of null ids only has a
    null component.  Repeated rows and ids repeat in the result; an empty table gives no rows; other columns
    are ignored.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, shingle))
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("rows")))
    total = nodes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    with_root = _with_root(nodes, max_bits)
    lows = with_root.groupBy("component").agg(F.min("low").alias("component_id"))
    named = with_root.join(lows, "component").select("fp", "component_id", "rows")
    return join_hot(prints, named, "fp", "rows", total).select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _with_root(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``nodes(fp)`` with ``component``, one fingerprint of the linked group."""
    linked = connected_components(near_links(nodes, max_bits)).select(F.col("node").alias("fp"), "component")
    return nodes.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def row_key(doc_id: Column, text: Column) -> Column:
    """Id and digest of the text in one key; a null id or text is a value of its own."""
    return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(F.md5(text.cast("binary")), F.lit("null")))


def simhash_survivors(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> tuple[DataFrame, int]:
    """``row_key, rows``, one row per group of linked fingerprints, and the number of rows of ``docs``.

    The survivor has the smallest id of its group (nulls last), then the smallest digest; ``rows`` is the number
    of input rows with its key.  Groups are told apart by fingerprint, so null and repeated ids do not join them.
    """
    view = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    view = view.withColumn("row_key", row_key(F.col("doc_id"), F.col("text")))

    def fn(cols):
        return {"doc_id": cols["doc_id"], "row_key": cols["row_key"], "fp": [simhash(t, shingle) for t in cols["text"]]}

    prints = map_texts(view, fn, "doc_id long, row_key string, fp long")
    keys = materialize(prints.groupBy("fp", "doc_id", "row_key").agg(F.count("*").alias("rows")))
    total = keys.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    low = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "rows"))
    nodes = materialize(keys.groupBy("fp").agg(low.alias("low")))
    return _with_root(nodes, max_bits).groupBy("component").agg(F.min("low").alias("low")).select("low.row_key", "low.rows"), total

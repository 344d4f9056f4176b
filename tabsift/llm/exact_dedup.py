"""Exact dedup by content-defined chunk recipes.

Every text is cut at rolling-hash boundaries.  Chunks become verified identifiers, a text becomes its ordered
identifier list (its recipe), and texts are equal when their recipes are.  Texts themselves are read
once, map-side, and never shuffled: only chunk digests (about 40 bytes for 2 kB) and recipes move.
"""

from __future__ import annotations

import hashlib

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import join_hot, map_texts
from .rolling import chunk_ends

AVERAGE, SMALLEST, LARGEST = 2048, 512, 16384

_CHUNKED = "doc_id long, n_bytes long, text_sha256 string, tags array<long>, proofs array<binary>"


def chunk_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the 64-bit tags of its chunks in order and each chunk's proof (SHA-256 and length)."""

    def fn(cols):
        out = {k: [] for k in ("doc_id", "n_bytes", "text_sha256", "tags", "proofs")}
        for doc_id, text in zip(cols["doc_id"], cols["text"]):
            data = (text or "").encode()
            tags, proofs, start = [], [], 0
            for end in chunk_ends(data, AVERAGE, SMALLEST, LARGEST):
                chunk = data[start:end]
                tags.append(xxhash.xxh3_64_intdigest(chunk) - 2**63)
                proofs.append(hashlib.sha256(chunk).digest() + len(chunk).to_bytes(4, "little"))
                start = end
            out["doc_id"].append(doc_id)
            out["n_bytes"].append(len(data))
            out["text_sha256"].append(hashlib.sha256(data).hexdigest())
            out["tags"].append(tags)
            out["proofs"].append(proofs)
        return out

    return map_texts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), fn, _CHUNKED)


def clashing_tags(chunked: DataFrame) -> DataFrame:
    """Tags held by chunks of different content (other proofs): ``tag``.  Empty unless 64-bit tags collide."""
    pairs = chunked.select(F.explode(F.arrays_zip("tags", "proofs")).alias("c")).select("c.tags", "c.proofs")
    return (
        pairs.groupBy(F.col("tags").alias("tag"))
        .agg(F.min(F.hex("proofs")).alias("lo"), F.max(F.hex("proofs")).alias("hi"))
        .where(F.col("lo") != F.col("hi"))
        .select("tag")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, n_bytes, n_chunks``; one row per input row.

    Texts are equal when byte-identical (null counts as empty; the empty text is an equal text like any
    other).  The row with the largest id stays; of rows repeating that id, all are marked kept.  A null
    id loses to any other.  An empty table gives no rows; other columns are ignored.

    A tag is an identifier once all chunks that hold it have the same SHA-256 and length; should a tag fail
    that test, recipes that contain it carry the proofs themselves instead, so a collision never joins
    two texts.
    """
    chunked = materialize(chunk_recipes(docs, id_col, text_col))
    clash = chunked.select("doc_id", "text_sha256", F.explode("tags").alias("tag")).join(clashing_tags(chunked), "tag")
    bad = clash.select("doc_id", "text_sha256").distinct().withColumn("clash", F.lit(True))
    verified = chunked.join(bad, ["doc_id", "text_sha256"], "left").select(
        "doc_id",
        "n_bytes",
        "text_sha256",
        F.size("tags").cast("long").alias("n_chunks"),
        F.col("tags").alias("recipe"),
        F.when(F.col("clash"), F.col("proofs")).alias("spelled"),
    )
    groups = materialize(
        verified.groupBy("recipe", "spelled").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.min("text_sha256").alias("text_sha256")
        )
    )
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    sized = groups.select(
        F.sha2(F.concat_ws(",", F.col("recipe").cast("array<string>"), F.transform("spelled", F.hex)), 256).alias("recipe_key"),
        "keep_id",
        "group_size",
        F.col("group_size").alias("rows"),
    )
    keyed = verified.select(
        "doc_id",
        "n_bytes",
        "n_chunks",
        "text_sha256",
        F.sha2(F.concat_ws(",", F.col("recipe").cast("array<string>"), F.transform("spelled", F.hex)), 256).alias("recipe_key"),
    )
    return join_hot(keyed, sized, "recipe_key", "rows", total).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        "n_bytes",
        "n_chunks",
    )

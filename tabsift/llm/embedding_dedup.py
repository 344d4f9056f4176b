"""Embedding near-dedup by PCA-ordered tiled comparison.

Unit vectors are turned to their principal axes (a rotation, so cosines stay), largest variance first.  Blocks of vectors are
compared tile by tile: the leading dimensions give partial products, the norms of the rest bound what can
still come (Cauchy-Schwarz), and a pair is left as soon as the sum can't reach the threshold.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import join_hot
from .components import connected_components

THRESHOLD = 0.9
#: Distinct vectors in a block, on average, and the side of a tile.
BLOCK, TILE = 8192, 1024
#: Dimensions added at each step.
STEP = 16
#: Pairs within this of the threshold are decided on the input's components.
MARGIN = 1e-9


def _clean(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    good = F.coalesce(usable, F.lit(False))
    return vectors.select(F.col(id_col).alias("vec_id"), F.when(good, v).alias("vec")).withColumn(
        "key", F.sha2(F.array_join(F.transform("vec", lambda x: x.cast("string")), ","), 256)
    )


def principal_axes(distinct: DataFrame, dim: int) -> np.ndarray:
    """Orthonormal axes of the unit vectors' second moments, largest first; ``dim`` ** 2 sums come to the driver."""

    def moments(batches):
        import pyarrow as pa

        total = np.zeros((dim, dim))
        for batch in batches:
            unit = _unit(_matrix(batch.column(0), dim))
            total += unit.T @ unit
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.reshape(-1))], names=["cell", "s"])

    rows = distinct.select("vec").mapInArrow(moments, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()
    m = np.zeros(dim * dim)
    for cell, s in rows:
        m[cell] = s
    return np.linalg.eigh(m.reshape(dim, dim))[1][:, ::-1]


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def tile_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row pairs of two tiles of rotated unit vectors whose cosine reaches ``threshold`` - MARGIN, and the cosines.

    After each STEP dimensions a pair lives on only if its partial product plus the product of the two suffix
    norms reaches the threshold.
    """
    dim = a.shape[1]
    rest_a, rest_b = _suffix_norms(a), _suffix_norms(b)
    low = threshold - MARGIN
    part = a[:, :STEP] @ b[:, :STEP].T
    i, j = np.nonzero(part + np.outer(rest_a[:, min(STEP, dim)], rest_b[:, min(STEP, dim)]) >= low)
    dot = part[i, j]
    for at in range(STEP, dim, STEP):
        if not len(i):
            break
        end = min(at + STEP, dim)
        dot = dot + np.einsum("ij,ij->i", a[i, at:end], b[j, at:end])
        live = dot + rest_a[i, end] * rest_b[j, end] >= low
        i, j, dot = i[live], j[live], dot[live]
    return i, j, dot


def _suffix_norms(x: np.ndarray) -> np.ndarray:
    squares = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(x), 1))], axis=1))


def spanning_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index connected to each of ``n`` by the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


LINKS = "key string, n long, root string"


def compare_blocks(axes: np.ndarray, threshold: float):
    """A pair of blocks (or one block) -> for each linked vector its number of links in the pair, and a vector it is connected to."""
    dim = len(axes)

    def fn(table):
        import pyarrow as pa

        rows = table.sort_by("block").to_pylist()
        own = [np.frombuffer(r["vecs"], "<f8").reshape(-1, dim) for r in rows]
        unit = [_unit(x) @ axes for x in own]
        keys = [k for r in rows for k in r["keys"]]
        copies = np.array([c for r in rows for c in r["copies"]], np.int64)
        inside = len(rows) == 1
        left, right, shift = unit[0], unit[-1], 0 if inside else len(unit[0])
        found_a, found_b = [], []
        for p in range(0, len(left), TILE):
            for q in range(p if inside else 0, len(right), TILE):
                i, j, dot = tile_pairs(left[p : p + TILE], right[q : q + TILE], threshold)
                i, j = i + p, j + q
                if inside:
                    once = i < j
                    i, j, dot = i[once], j[once], dot[once]
                sure = dot >= threshold + MARGIN
                near = np.flatnonzero(~sure)
                if len(near):
                    x, y = own[0][i[near]], own[-1][j[near]]
                    exact = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
                    sure[near] = exact >= threshold
                found_a.append(i[sure])
                found_b.append(j[sure] + shift)
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        n = np.zeros(len(keys), np.int64)
        np.add.at(n, a, copies[b])
        np.add.at(n, b, copies[a])
        root = spanning_roots(len(keys), a, b)
        linked = np.flatnonzero(n)
        return pa.table({
            "key": pa.array([keys[k] for k in linked], pa.string()),
            "n": pa.array(n[linked]),
            "root": pa.array([keys[r] for r in root[linked]], pa.string()),
        })

    return fn


def _pack(table):
    import pyarrow as pa

    rows = table.sort_by("key")
    vecs = rows.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<f8").tobytes()
    return pa.table({
        "block": pa.array([rows.column("block")[0].as_py()], pa.int64()),
        "keys": pa.array([rows.column("key").to_pylist()], pa.list_(pa.string())),
        "copies": pa.array([rows.column("copies").to_pylist()], pa.list_(pa.int64())),
        "vecs": pa.array([vecs], pa.binary()),
    })


def _links(distinct: DataFrame, dim: int, threshold: float) -> DataFrame:
    """Links among distinct vectors of one dimension.  Blocks are dealt by hash; each pair of blocks is one task's work."""
    blocks = max(1, -(-distinct.count() // BLOCK))
    packed = materialize(
        distinct.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
        .groupBy("block")
        .applyInArrow(_pack, "block long, keys array<string>, copies array<long>, vecs binary")
    )
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))
    met = packed.withColumn("other", other).select(
        F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "keys", "copies", "vecs"
    )
    return met.groupBy("lo", "hi").applyInArrow(compare_blocks(principal_axes(distinct, dim), threshold), LINKS)


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept``; one row per input row.

    Links join vectors of the same dimension with cosine at least ``threshold`` in double precision.  Null, zero and
    empty vectors and such with null or non-finite components link with nothing and are their own
    component.  Equal vectors are compared once and count as linked with one another; a repeated row is another vector.
    ``kept`` says that the row's id is its component's smallest.  A null id stays null and is not kept.  An
    empty table gives no rows; other columns are ignored.
    """
    rows = materialize(_clean(vectors, id_col, vec_col))
    distinct = materialize(
        rows.where(F.col("vec").isNotNull()).groupBy("key").agg(F.first("vec").alias("vec"), F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    )
    total = distinct.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    links = None
    for dim in sorted(r[0] for r in distinct.select(F.size("vec")).distinct().collect()):
        part = _links(distinct.where(F.size("vec") == dim).select("key", "vec", "copies"), dim, threshold)
        links = part if links is None else links.unionByName(part)
    if links is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    links = materialize(links)
    degree = links.groupBy("key").agg(F.sum("n").alias("n"))
    parts = connected_components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    named = (
        distinct.select("key", "copies", "low")
        .join(degree, "key", "left")
        .join(parts.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = named.join(lows, "component").select(
        "key", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id", "copies"
    )
    done = join_hot(rows.where(F.col("vec").isNotNull()).select("vec_id", "key"), classes, "key", "copies", total)
    alone = rows.where(F.col("vec").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (
        done.select("vec_id", "n_links", "component_id")
        .unionByName(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )

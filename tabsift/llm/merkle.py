"""Merkle manifest of a data set, with a witness for every row, built by incremental witnesses.

Leaves are appended to an open tree one after another.  Every subtree that is still open keeps the partial witnesses of its
leaves, and a subtree completed beside it extends them.  Leaves are appended in aligned blocks, all blocks at
once; the block roots are further appends to the tree above, in blocks of their own, until one node of the group
is left, and the groups' roots are appended to the last tree.  Nothing but a block, a block's path and the
per-partition counts behind the positions is ever in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: A block holds 2 ** BLOCK_LEVELS leaves.
BLOCK_LEVELS = 12

_NODE = "g string, pos long, n long, digest string"
_PATH = "sides string, siblings string"


def digest_of(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class OpenTree:
    """Append-only tree of pairs.  ``steps[i]`` is the witness of leaf ``i`` so far, a list of (side, sibling): the sibling stands
    on the left (``L``), on the right (``R``), or there is none (``N``) and the node is hashed alone."""

    def __init__(self):
        self.steps: list[list[tuple[str, str]]] = []
        self._open: list[tuple[int, str, list[int]]] = []  # level, digest, leaves; levels fall from left to right

    def append(self, digest: str) -> None:
        self._open.append((0, digest, [len(self.steps)]))
        self.steps.append([])
        self._join()

    def _join(self) -> None:
        while len(self._open) > 1 and self._open[-1][0] == self._open[-2][0]:
            (level, left, of_left), (_, right, of_right) = self._open[-2:]
            for i in of_left:
                self.steps[i].append(("R", right))
            for i in of_right:
                self.steps[i].append(("L", left))
            self._open[-2:] = [(level + 1, digest_of(left, right), of_left + of_right)]

    def close(self, levels: int = 0) -> str:
        """Root, at least ``levels`` above the leaves; a node without a neighbour is hashed alone on its way up."""
        while len(self._open) > 1 or self._open[-1][0] < levels:
            level, digest, leaves = self._open[-1]
            for i in leaves:
                self.steps[i].append(("N", ""))
            self._open[-1] = (level + 1, digest_of(digest), leaves)
            self._join()
        return self._open[0][1]


def leaf_text(columns: Sequence[Column]) -> Column:
    """Each value as its UTF-8 byte count, ``:`` and the value; ``-`` for null."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def positions(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``pos`` (rank within ``group`` by ``order``, from 0) and ``n`` (rows of the group).

    Rows are dealt by ranges of (group, order), equal ones too, so a group of any size is spread.  What is counted
    is one row per group and partition."""
    mixed = F.monotonically_increasing_id()  # breaks ties of rows that are alike, whichever way
    ranged = df.withColumn("tie", F.xxhash64(mixed)).repartitionByRange(group, *order, "tie").sortWithinPartitions(group, *order, "tie")
    numbered = materialize(ranged.drop("tie").withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).alias("part")
    by_group = Window.partitionBy(group)
    before = by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = numbered.groupBy(group, part).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    starts = starts.select(
        group, "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"), F.sum("rows").over(by_group).alias("n")
    )
    placed = numbered.withColumn("part", part).join(starts, [group, "part"])
    return placed.withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("part", "first", "before", "at")


def _grow(table, levels: int):
    """The rows of one block in order, their tree, and its root; ``levels`` is the height of a full block."""
    rows = table.sort_by("pos")
    tree = OpenTree()
    for digest in rows.column("digest").to_pylist():
        tree.append(digest)
    n = rows.column("n")[0].as_py()
    return rows, tree, tree.close(levels if n > 1 << levels else 0)


def _block(levels: int) -> Column:
    return F.shiftright("pos", levels).alias("block")


def climb(nodes: DataFrame, levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """``nodes`` (g, pos, n, digest) and the block roots above them, round by round, up to one node for each ``g``."""
    import pyarrow as pa

    def root(table: pa.Table) -> pa.Table:
        rows, _, top = _grow(table, levels)
        g, pos, n = (rows.column(c)[0].as_py() for c in ("g", "pos", "n"))
        return pa.table({"g": pa.array([g], pa.string()), "pos": [pos >> levels], "n": [-(-n >> levels) if n else 0], "digest": [top]})

    rounds = [nodes]
    while True:
        nodes = materialize(rounds[-1].select("g", "pos", "n", "digest").groupBy("g", _block(levels)).applyInArrow(root, _NODE))
        rounds.append(nodes)
        if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
            return rounds


def descend(rounds: list[DataFrame], tops: DataFrame, carry: str = "", levels: int = BLOCK_LEVELS) -> DataFrame:
    """Witnesses of the first round's nodes: ``sides``, ``siblings`` (64 characters each), ``top``, and the columns that ``carry``
    declares.  ``tops`` (g, top, sides, siblings) says what follows above the root of each ``g``."""
    import pyarrow as pa

    extra = [c.split()[0] for c in carry.split(",") if c]

    def extend_with(names: list[str]):
        def extend(table: pa.Table, above: pa.Table) -> pa.Table:
            rows, tree, _ = _grow(table, levels)
            sides, siblings, top = (above.column(c)[0].as_py() for c in ("sides", "siblings", "top"))
            out = {c: rows.column(c) for c in names}
            out["top"] = [top] * rows.num_rows
            out["sides"] = ["".join(s for s, _ in steps) + sides for steps in tree.steps]
            out["siblings"] = ["".join(d for _, d in steps) + siblings for steps in tree.steps]
            return pa.table({k: v if isinstance(v, pa.ChunkedArray) else pa.array(v, pa.string()) for k, v in out.items()})

        return extend

    paths = tops.select("g", F.lit(0).cast("long").alias("pos"), "top", "sides", "siblings")
    for i in range(len(rounds) - 2, -1, -1):
        names, schema = ["g", "pos"], "g string, pos long"
        if i == 0 and carry:
            names, schema = names + extra, f"{schema}, {carry}"
        nodes = rounds[i].select(*dict.fromkeys(["g", "pos", "n", "digest", *(extra if i == 0 else [])]))
        paths = (
            nodes.groupBy("g", _block(levels))
            .cogroup(paths.withColumnRenamed("pos", "block").groupBy("g", "block"))
            .applyInArrow(extend_with(names), f"{schema}, top string, {_PATH}")
        )
    return paths


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
    carry_schema: str = "",
    levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per input row: ``order`` (as ``doc_id``), ``leaf``, ``position``, ``n_leaves``, ``subroot``, ``root`` and its witness as
    ``sides`` and ``siblings`` (concatenated hex digests, bottom up), plus the columns of ``carry`` (``carry_schema`` declares them).

    Leaves of a group ascend by ``order``, a null one first, equal ones by leaf; rows that are alike keep leaves of their own.  Groups
    ascend by UTF-8 bytes, null first, and an empty group name differs from null.  Null values are leaves like any other, texts
    of any length are hashed whole where they lie and not moved.  An empty table gives no rows; other columns are ignored.
    """
    extra = dict(carry or {})
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit("")).alias("g"),
        F.col(order).cast("long").alias("doc_id"),
        F.sha2(leaf_text([F.col(c) for c in columns]), 256).alias("digest"),
        *(c.alias(k) for k, c in extra.items()),
    )
    placed = materialize(positions(materialize(leaves), "g", ["doc_id", "digest"]))
    rounds = climb(placed, levels)
    subroots = rounds[-1].select(F.col("g").alias("name"), "digest")
    above = climb(positions(subroots.withColumn("g", F.lit("")), "g", ["name"]), levels)
    last = above[-1].first()
    root = last["digest"] if last else ""
    whole = above[-1].select("g", F.col("digest").alias("top"), F.lit("").alias("sides"), F.lit("").alias("siblings"))
    tops = descend(above, whole, "name string, digest string", levels).select(F.col("name").alias("g"), F.col("digest").alias("top"), "sides", "siblings")
    kept = ["doc_id long, digest string, n long", *filter(None, [carry_schema])]
    return descend(rounds, materialize(tops), ", ".join(kept), levels).select(
        "doc_id",
        F.col("digest").alias("leaf"),
        F.col("pos").alias("position"),
        F.col("n").alias("n_leaves"),
        F.col("top").alias("subroot"),
        F.lit(root).alias("root"),
        "sides",
        "siblings",
        *extra,
    )


def fold(leaf: Column, sides: Column, siblings: Column) -> Column:
    """Root that a leaf and its witness lead to."""

    def step(state: Column, side: Column) -> Column:
        node, at = state["node"], state["at"]
        sibling = F.substring(siblings, at, F.lit(64))
        return F.struct(
            F.when(side == "L", F.sha2(F.concat(sibling, node), 256))
            .when(side == "R", F.sha2(F.concat(node, sibling), 256))
            .when(side == "N", F.sha2(node, 256))
            .otherwise(node)
            .alias("node"),
            F.when(side.isin("L", "R"), at + 64).otherwise(at).alias("at"),
        )

    start = F.struct(leaf.alias("node"), F.lit(1).alias("at"))
    return F.aggregate(F.split(sides, ""), start, step, lambda state: state["node"])

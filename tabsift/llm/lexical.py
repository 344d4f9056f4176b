"""Ranked lexical search by Aho-Corasick document scan.

All terms of all items form one automaton, each term guarded by a boundary on both sides, which is sent to the tasks.  One scan
over the texts counts what the weights need (documents, terms, documents per term); a second scan counts term frequencies
again, maps the automaton's outputs to items and keeps each task's best documents of each item.  No index of the
documents is made, and no row per document and term ever leaves a task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import _slices

#: Terms (with their items) of one automaton hold at most about this many bytes; more items are taken in blocks, a scan each.
AUTOMATON_BYTES = 2_000_000

# Fixed value: what a term consists of (all but ASCII characters that are neither letters nor digits).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A-Z become lower case, ASCII bytes outside terms become a space, the bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Cells (documents x items) scored at a time.
CELLS = 1_000_000
_NO_ID = 2**63 - 1

_BEST = "item int, doc_id long, score long"


def fold_text(text: str | None) -> bytes:
    """UTF-8 text with one space or more between its terms, before the first and after the last."""
    return b" " + (text or "").encode().translate(_FOLD) + b" "


def count_terms(folded: bytes) -> int:
    gap = np.frombuffer(folded, np.uint8) == 32
    return int(np.count_nonzero(gap[:-1] & ~gap[1:]))


class Automaton:
    """Finds the given terms in folded texts, whole terms only."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            self.machine.add_word(f" {term} ", i)
        self.empty = not terms
        if terms:
            self.machine.make_automaton()

    def count(self, folded: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Terms found and how often; adjacent terms share the space between them."""
        if self.empty:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = np.fromiter((value for _, value in self.machine.iter(folded.decode())), np.int64)
        return np.unique(found, return_counts=True)


@dataclass
class Items:
    """A block of items: their ids, the distinct terms, and the items of term ``t`` as ``of_term[start[t]:start[t + 1]]``."""

    ids: list
    terms: list[str]
    start: np.ndarray
    of_term: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> "Items":
        ids = [item for item, _ in rows]
        users: dict[str, list[int]] = {}
        for i, (_, terms) in enumerate(rows):
            for t in sorted(set(terms)):
                users.setdefault(t, []).append(i)
        sizes = [len(u) for u in users.values()]
        return cls(ids, list(users), np.cumsum([0, *sizes]), np.array([i for u in users.values() for i in u], np.int64))


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item_id, terms``: the distinct terms of each item; rows of one id are one item."""
    folded = F.translate(F.col(text_col), _UPPER, _LOWER)
    one = items.select(F.col(item_col).alias("item_id"), F.explode(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))).alias("term"))
    return one.groupBy("item_id").agg(F.collect_set("term").alias("terms"))


def document_frequencies(view: DataFrame, terms: list[str]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and documents that hold each of ``terms``."""

    def count(batches):
        import pyarrow as pa

        machine, sums = Automaton(terms), np.zeros(len(terms) + 2, np.int64)

        def add(cols):
            for text in cols["text"]:
                folded = fold_text(text)
                n = count_terms(folded)
                if n:
                    sums[machine.count(folded)[0]] += 1
                    sums[-2:] += (1, n)

        for _ in sliced(batches, add):
            pass
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(sums[cells])], names=["cell", "n"])

    rows = view.select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect()
    total = np.zeros(len(terms) + 2, np.int64)
    for cell, n in rows:
        total[cell] = n
    return int(total[-2]), int(total[-1]), total[:-2]


def sliced(batches, fn):
    """``fn`` over slices of bounded size of every batch."""
    for batch in batches:
        for part in _slices(batch, "text"):
            yield fn({name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)})


class Best:
    """The ``k`` best (score, smaller id first) of every item among the documents seen."""

    def __init__(self, n_items: int, k: int):
        self.k, self.floor = k, np.zeros(n_items, np.int64)  # nothing below the floor is among the best
        self.kept = np.zeros((3, 0), np.int64)  # item, id, score
        self.new: list[np.ndarray] = []
        self.waiting = 0

    def add(self, first_item: int, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: documents x items from ``first_item`` on."""
        floor = self.floor[first_item : first_item + scores.shape[1]]
        doc, item = np.nonzero((scores > 0) & (scores >= floor))
        self.new.append(np.stack([item + first_item, ids[doc], scores[doc, item]]))
        self.waiting += len(doc)
        if self.waiting > max(100_000, 4 * self.kept.shape[1]):
            self.settle()

    def settle(self) -> np.ndarray:
        rows = np.concatenate([self.kept, *self.new], axis=1)
        rows = rows[:, np.lexsort((rows[1], -rows[2], rows[0]))]
        starts = np.flatnonzero(np.diff(rows[0], prepend=-1))
        rank = np.arange(rows.shape[1]) - np.repeat(starts, np.diff(np.append(starts, rows.shape[1])))
        self.kept, self.new, self.waiting = rows[:, rank < self.k], [], 0
        last = rows[:, rank == self.k - 1]
        self.floor[last[0]] = last[2]
        return self.kept


def rank_block(view: DataFrame, items: Items, k: int, salts: int) -> DataFrame:
    """The ``k`` best documents of each of a block of items, ``item, doc_id, score, rank``; the block's index of an item is ``item``."""
    n_docs, n_terms, df = document_frequencies(view, items.terms)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)

    def scan(batches):
        import pyarrow as pa

        machine, best, n_items = Automaton(items.terms), Best(len(items.ids), k), len(items.ids)
        width = np.diff(items.start)

        def add(cols):
            rows: list = []
            for doc_id, text in zip(cols["doc_id"], cols["text"]):
                folded = fold_text(text)
                term, tf = machine.count(folded)
                if len(term):
                    m = 50 + (50 * count_terms(folded) * n_docs) // n_terms
                    rows.append((_NO_ID if doc_id is None else doc_id, term, weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m))))
            step = max(1, CELLS // max(n_items, 1))
            for a in range(0, len(rows), step):
                part = rows[a : a + step]
                ids = np.array([r[0] for r in part], np.int64)
                scores = np.zeros(len(part) * n_items, np.int64)
                for d, (_, term, value) in enumerate(part):
                    users = width[term]
                    at = np.repeat(items.start[term] - np.cumsum(users) + users, users) + np.arange(users.sum())
                    row = np.bincount(items.of_term[at], np.repeat(value, users), n_items)  # sums below 2 ** 53 are exact
                    scores[d * n_items : (d + 1) * n_items] = row
                best.add(0, ids, scores.reshape(len(part), n_items))

        for _ in sliced(batches, add):
            pass
        rows = best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1]), pa.array(rows[2])], names=["item", "doc_id", "score"])

    found = view.select("doc_id", "text").mapInArrow(scan, _BEST)
    order = [F.col("score").desc(), F.col("doc_id")]
    some = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("salt")


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    automaton_bytes: int = AUTOMATON_BYTES,
    salts: int = 16,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 for each item, ranks from 1, equal scores by id.

    Terms are runs of characters other than ASCII marks, spaces and controls; only A-Z are folded.  A null text has no terms, whether
    document or item; an item without terms has no rows, nor has one none of whose terms is found.  Rows with one item id are
    one item, whose terms are taken once; repeated documents are ranked each.  A null document id comes last among equal
    scores, a null item id is an id like any other.  Texts of any length are read whole.  Empty tables give no rows; other
    columns are ignored.

    Items travel to every task, so their size is measured: beyond ``automaton_bytes`` they are dealt into blocks of about
    that size (one larger item is a block), and the documents are scanned for each block.
    """
    view = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    wanted = materialize(item_terms(items, item_col, item_text_col))
    size = F.octet_length(F.concat_ws(" ", "terms")) + 8 * F.size("terms")
    total = wanted.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    blocks = max(1, -(-total // automaton_bytes))
    dealt = wanted.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    out = None
    for b in range(blocks):
        rows = sorted(map(tuple, dealt.where(F.col("block") == b).select("item_id", "terms").collect()), key=lambda r: str(r[0]))
        block = Items.of(rows)
        names = view.sparkSession.createDataFrame(
            [(i, item) for i, item in enumerate(block.ids)], f"item int, item_id {dict(wanted.dtypes)['item_id']}"
        )
        ranked = rank_block(view, block, k, salts).join(F.broadcast(names), "item")
        ranked = ranked.select(
            "item_id", "rank", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias("doc_id"), "score"
        )
        ranked = materialize(ranked) if blocks > 1 else ranked
        out = ranked if out is None else out.unionByName(ranked)
    return out

"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts given to one call of a Python batch function hold at most this many characters together
#: (a single longer text is a batch of its own).
BATCH_CHARS = 4_000_000

#: A key is hot when it holds more than one part in HOT_PARTS of all rows; so at most HOT_PARTS keys are hot.
HOT_PARTS = 200


def drop_idle_coders() -> None:
    """Free the vocabularies that an earlier stage left in this worker; a stage that encodes loads its own again."""
    import sys

    coders = getattr(sys.modules.get("tabsift.llm.bpe"), "_CODERS", None)
    if coders:
        coders.clear()


def lang_mod(doc_id: Column) -> Column:
    """crc32 of the decimal text of the id, modulo 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def map_texts(df: DataFrame, fn: Callable[..., Iterator[dict] | dict], schema: str, text: str = "text") -> DataFrame:
    """``mapInArrow`` over bounded slices: ``fn(columns: dict of lists) -> dict of lists`` (or an iterator of them).

    A null text reaches ``fn`` as None.  Rows are cut into slices of at most BATCH_CHARS characters, so
    a batch of long texts is never held as Python strings at once.
    """
    arrow = _arrow_schema(df, schema)

    def run(batches):
        for batch in batches:
            for part in _slices(batch, text):
                out = fn({name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)})
                for cols in [out] if isinstance(out, dict) else out:
                    yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, text: str):
    import pyarrow.compute as pc

    col = batch.column(batch.schema.names.index(text))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > BATCH_CHARS:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield batch.slice(start)


def _arrow_schema(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def join_hot(left: DataFrame, right: DataFrame, key: str, rows_of_key: str, total: int, how: str = "inner") -> DataFrame:
    """Equi-join of ``left`` with ``right`` (one row per key) that splits hot keys.

    ``right[rows_of_key]`` says how many rows of ``left`` hold the key and ``total`` how many rows there
    are.  Fewer than HOT_PARTS keys can hold more than ``total / HOT_PARTS`` rows each; those few rows of
    ``right`` are broadcast, so a hot key's rows of ``left`` are never moved.  All other keys are
    shuffled, and none of them is large.  ``rows_of_key`` is kept out of the result.
    """
    bound = total / HOT_PARTS
    hot = right.where(F.col(rows_of_key) > bound).drop(rows_of_key)
    rest = right.where(F.col(rows_of_key) <= bound).drop(rows_of_key)
    marks = hot.select(F.col(key).alias("_hot_key"))
    flagged = left.join(F.broadcast(marks), F.col(key).eqNullSafe(F.col("_hot_key")), "left")
    of_hot = flagged.where(F.col("_hot_key").isNotNull()).drop("_hot_key").join(F.broadcast(hot), key, how)
    of_rest = flagged.where(F.col("_hot_key").isNull()).drop("_hot_key").join(rest, key, how)
    return of_hot.unionByName(of_rest)


#: Bits of a filter, whatever the number of its keys (8 MB); beyond some 100 million keys it lets more and more others pass.
FILTER_BITS = 26
#: Bits of a row of the filter.
_ROW_BITS = 15


def _bit_rows(keys: DataFrame, key: str) -> DataFrame:
    """``_row, _bits``: at most 2 ** 11 rows of 4 kB with the bits of the keys' hashes set."""
    at = F.xxhash64(key).bitwiseAND(F.lit(2**FILTER_BITS - 1))
    bits = keys.where(F.col(key).isNotNull()).select(F.shiftright(at, _ROW_BITS).alias("_row"), at.bitwiseAND(F.lit(2**_ROW_BITS - 1)).alias("_bit"))
    return bits.distinct().repartition("_row").groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def _bit_of(key: str) -> tuple[Column, Column]:
    """The row of the filter that holds a key's bit, and whether the bit is set in that row's ``_bits``."""
    at = F.xxhash64(key).bitwiseAND(F.lit(2**FILTER_BITS - 1))
    bit = at.bitwiseAND(F.lit(2**_ROW_BITS - 1))
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.shiftright(at, _ROW_BITS), byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0


def maybe_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys``, and by chance some others (none with a null key): what an exact join
    by ``key`` needs, told before anything is moved.  The filter that is broadcast has 2 ** FILTER_BITS bits."""
    row, is_set = _bit_of(key)
    met = df.join(F.broadcast(_bit_rows(keys, key)), row == F.col("_row"))
    return met.where(is_set).where(F.col(key).isNotNull()).select(*df.columns)


def mark_maybe_in(df: DataFrame, keys: DataFrame, key: str, mark: str) -> DataFrame:
    """All rows of ``df``, those of :func:`maybe_in` with a true ``mark``, the others with a false one."""
    row, is_set = _bit_of(key)
    met = df.join(F.broadcast(_bit_rows(keys, key)), row == F.col("_row"), "left")
    return met.select(*df.columns, (F.coalesce(is_set, F.lit(False)) & F.col(key).isNotNull()).alias(mark))


def collect_bits(keys: DataFrame, key: str) -> bytes:
    """The same filter as bytes, for :func:`has_bit` in Python; its size does not depend on the keys."""
    out = bytearray(2 ** (FILTER_BITS - 3))
    size = 2 ** (_ROW_BITS - 3)
    for row, bits in _bit_rows(keys, key).collect():
        out[row * size : (row + 1) * size] = bits
    return bytes(out)


def has_bit(bits: bytes, text: str) -> bool:
    """Whether a text may be among the keys of :func:`collect_bits`."""
    at = xxhash.xxh64_intdigest(text, 42) & (2**FILTER_BITS - 1)
    return bits[at >> 3] >> (at & 7) & 1 == 1

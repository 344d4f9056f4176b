"""Category encoding and vector assembly (F1-F4) on ``pyspark.ml`` feature transformers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsift.functions.exprs import qcol
from tabsift.operators.weights import MAX_BROADCAST_BYTES, ROW_BYTES
from tabsift.session import materialize


def index_suffix(col: str) -> str:
    return f"{col}_index"


def fit_indexer(
    df: DataFrame,
    cols: Sequence[str],
    handle_invalid: str = "keep",
    order: str = "frequencyDesc",
    output_cols: Sequence[str] | None = None,
) -> StringIndexerModel:
    """most frequent value -> 0, ties alphabetical; with ``keep`` null/unseen -> index K.

    The fit is one distributed value count; only the K distinct labels reach the driver, which the
    model has to hold anyway.
    """
    cols = list(cols)
    outs = list(output_cols) if output_cols else [index_suffix(c) for c in cols]
    indexer = StringIndexer(inputCols=cols, outputCols=outs, handleInvalid=handle_invalid, stringOrderType=order)
    return indexer.fit(df)


def index_categories(
    df: DataFrame, cols: Sequence[str], handle_invalid: str = "keep", order: str = "frequencyDesc"
) -> DataFrame:
    """add ``<col>_index`` double columns (fit and transform on ``df``)."""
    return fit_indexer(df, cols, handle_invalid, order).transform(df)


def with_handle_invalid(model: StringIndexerModel, handle_invalid: str) -> StringIndexerModel:
    """Copy of a fitted indexer with another invalid-value policy (e.g. fit with ``error`` on train,
    apply with ``keep`` on test so an unseen label gets index K instead of failing)."""
    return model.copy({model.handleInvalid: handle_invalid})


def category_ranks(df: DataFrame, col: str) -> DataFrame:
    """F1 for any number of categories: ``value, n, index`` (most frequent 0, ties by value), written to the shared folder.

    The counts are dealt by ranges of (frequency, value) and numbered by range, so no task and not the driver ever holds all
    categories; what is gathered is one count per range."""
    counts = df.groupBy(qcol(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).where("value is not null")
    ranged = counts.repartitionByRange(F.col("n").desc(), "value").sortWithinPartitions(F.col("n").desc(), "value")
    numbered = materialize(ranged.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).alias("part")
    sizes = numbered.groupBy(part).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("part", "first", before.alias("before"))  # a row per range
    placed = numbered.withColumn("part", part).join(F.broadcast(starts), "part")
    return materialize(placed.select("value", "n", (F.col("at") - F.col("first") + F.col("before")).alias("index")))


def index_by_ranks(
    df: DataFrame, col: str, ranks: DataFrame, output_col: str | None = None, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """add the index of ``col`` from a table of :func:`category_ranks`; null and unseen values get K, one beyond the last.

    The table is broadcast if its measured size allows, else joined by a shuffle in which the most frequent values, as many as
    may be broadcast, are still looked up where their rows lie, so no hot category is moved."""
    out = output_col or index_suffix(col)
    size = F.octet_length("value") + ROW_BYTES
    k, total = ranks.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    table = ranks.select(F.col("value").alias("__value"), F.col("index").alias("__index"))
    key, keep = qcol(col).cast("string"), [qcol(c) for c in df.columns]
    index = F.coalesce(F.col("__index"), F.lit(k)).cast("double").alias(out)
    if total <= max_broadcast_bytes:
        return df.join(F.broadcast(table), key == F.col("__value"), "left").select(*keep, index)
    frequent = int(k * max_broadcast_bytes / total)
    hot, rest = table.where(F.col("__index") < frequent), table.where(F.col("__index") >= frequent)
    known = df.join(F.broadcast(hot), key == F.col("__value"), "left")
    found = F.col("__index").isNotNull() | qcol(col).isNull()
    others = known.where(~found).select(*keep).join(rest.hint("shuffle_merge"), key == F.col("__value"), "left")
    return known.where(found).select(*keep, index).unionByName(others.select(*keep, index))


def one_hot(
    df: DataFrame,
    index_cols: Sequence[str],
    output_cols: Sequence[str] | None = None,
    drop_last: bool = True,
    handle_invalid: str = "error",
) -> DataFrame:
    """one-hot vectors of index columns.  After a ``keep`` indexer the unknown value is already
    category K of the metadata, so with ``drop_last`` the vector has K slots and unknown is all zeros.
    ``handle_invalid="keep"`` here would add yet another slot for indices outside the metadata."""
    index_cols = list(index_cols)
    outs = list(output_cols) if output_cols else [c.removesuffix("_index") + "_vec" for c in index_cols]
    enc = OneHotEncoder(inputCols=index_cols, outputCols=outs, dropLast=drop_last, handleInvalid=handle_invalid)
    return enc.fit(df).transform(df)


def assembler(cols: Sequence[str], output_col: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=output_col, handleInvalid=handle_invalid)


def assemble(df: DataFrame, cols: Sequence[str], output_col: str = "features", handle_invalid: str = "error") -> DataFrame:
    """assemble a feature vector.  ``error`` fails on null/NaN; ``skip`` drops those rows (Inf
    is kept, MLlib only checks null/NaN); ``keep`` writes NaN."""
    return assembler(cols, output_col, handle_invalid).transform(df)


def slot_names(df: DataFrame, vector_col: str) -> list[str]:
    """Per-slot names of an assembled vector from its ML attribute metadata (one-hot columns give one
    name per slot, D8).  Falls back to ``<col>_<i>`` when the column carries only a size."""
    meta = df.schema[vector_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = sorted((a["idx"], a.get("name", f"{vector_col}_{a['idx']}")) for group in attrs.values() for a in group)
    if slots:
        return [name for _, name in slots]
    size = meta.get("num_attrs")
    if size is None:
        first = df.select(vector_col).head()
        size = len(first[0]) if first is not None else 0
    return [f"{vector_col}_{i}" for i in range(size)]


def vector_size(df: DataFrame, vector_col: str) -> int:
    """Slot count from metadata when present (no job), else from one row."""
    meta = df.schema[vector_col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    attrs = meta.get("attrs", {})
    if attrs:
        return sum(len(g) for g in attrs.values())
    first = df.select(vector_col).head()
    return len(first[0]) if first is not None else 0


def encoder_stages(
    numerics: Sequence[str], categoricals: Sequence[str] = (), output_col: str = "features", invalid: str = "error", order: str = "frequencyDesc"
) -> list:
    """F1-F3 as stages of a pipeline: index -> one-hot -> assemble.  A category that the training rows lack (null too) has zeros in all
    slots of its column; ``invalid`` says what a null or NaN number does to its row (F4)."""
    cats, stages = list(categoricals), []
    indices, vectors = [index_suffix(c) for c in cats], [f"{c}_vec" for c in cats]
    if cats:
        stages.append(StringIndexer(inputCols=cats, outputCols=indices, handleInvalid="keep", stringOrderType=order))
        stages.append(OneHotEncoder(inputCols=indices, outputCols=vectors, dropLast=True, handleInvalid="error"))
    return [*stages, assembler([*numerics, *vectors], output_col, invalid)]


def slot_sources(model: PipelineModel) -> list[tuple[str, str]]:
    """``(slot, column)`` for every slot of the vector that a fitted (or reloaded) pipeline assembles: a numeric column is its own slot,
    a category is ``column=value``."""
    of_index: dict[str, tuple[str, list[str]]] = {}
    of_vector: dict[str, list[tuple[str, str]]] = {}
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            for source, out, labels in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray):
                of_index[out] = (source, list(labels))
        elif isinstance(stage, OneHotEncoderModel):
            for index, out, size in zip(stage.getInputCols(), stage.getOutputCols(), stage.categorySizes):
                source, labels = of_index[index]
                names = [f"{source}={v}" for v in labels] + [f"{source}=(other)"] * (size - len(labels))
                of_vector[out] = [(n, source) for n in (names[:-1] if stage.getDropLast() else names)]
        elif isinstance(stage, VectorAssembler):
            return [slot for c in stage.getInputCols() for slot in of_vector.get(c, [(c, c)])]
    raise ValueError("the pipeline assembles no vector")

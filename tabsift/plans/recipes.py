"""End-to-end recipes (E1-E4) composed from the operators.

Order of work differs from the reference on purpose: in ``prepare`` the split comes *first* and the
label index, class weights, encoders and feature selection are fitted on the training rows only (D15).
``clean`` learns on the whole table, as the reference's cleaning does, or on the training rows (``fit_on="train"``, which
``run_raw`` uses); de-duplication runs before encoding (same result, narrower rows).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsift.functions.exprs import is_missing, qcol
from tabsift.operators import clean as C
from tabsift.operators.encode import fit_indexer, slot_sources, with_handle_invalid
from tabsift.operators.evaluate import compare_configs
from tabsift.operators.features import (
    backproject_importance,
    column_importance,
    explained_variance,
    importance_table,
    select_top_columns,
    select_top_features,
)
from tabsift.operators.fitted import Cleaner, CleanerModel
from tabsift.operators.profile import class_distribution, profile_columns, profile_uncastable, sentinel_match, split_sizes
from tabsift.operators.split import assign_split, split
from tabsift.operators.weights import class_weights, with_class_weight
from tabsift.session import WIDE, compile_wide, compiled_apart, materialize
from tabsift.sources.delimited import read_delimited
from tabsift.spec import ForestConfig, TableSpec, default_configs


#: Name of the column that holds a row's half in written tables.
HALF = "__half"


def normalize(df: DataFrame, spec: TableSpec, sentinel_value: str | None = None) -> DataFrame:
    """Dotted names -> underscores, lower-case categoricals, sentinels replaced; one projection.

    Categorical sentinels become null (later ``unknown``), not ``"0"`` which would create a class named
    "0" (D23); numeric text sentinels become ``sentinel_value`` (null by default: they are missing).
    """
    cats, exprs = {*spec.categoricals, spec.label}, []
    for f, name in zip(df.schema.fields, C.normalized_names(df.columns)):
        value = qcol(f.name)
        if isinstance(f.dataType, T.StringType):
            value = F.lower(value) if name in cats else value
            fill = None if name in cats else sentinel_value
            value = F.when(sentinel_match(value, spec.sentinels, name in cats), F.lit(fill).cast("string")).otherwise(value)
        exprs.append(value.alias(name))
    return df.select(*exprs)


@dataclass
class Cleaned:
    df: DataFrame
    uncastable: DataFrame | None
    constant: list[str]
    model: CleanerModel

    @cached_property
    def after(self) -> DataFrame:
        """P5: the profile of the cleaned table."""
        return profile_columns(self.df)


def cleaner_for(df: DataFrame, spec: TableSpec, strategy: str = "median", unseen: str = "keep") -> Cleaner:
    """The fitted cleaning a table's roles ask for."""
    numerics = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in (spec.label, spec.key)]
    present = lambda cols: [c for c in cols if c in df.columns]
    cats = present((*spec.categoricals, spec.label))
    return Cleaner(numerics, cats, [c for c in present(spec.non_negative) if c in numerics], strategy, "unknown", unseen)


#: A wide table that may hold more than this is not written whole by cleaning (8 bytes a value).
WRITTEN_BYTES = 32_000_000_000


def distinct_written(df: DataFrame) -> DataFrame:
    """The table without repeated rows; the same table gives the same order of rows, on which fits depend.

    It is written once, unless it is wide and may hold more than ``WRITTEN_BYTES``: then each pass works its rows out again, and only what
    is left of repeated rows is written."""
    large = len(df.columns) >= WIDE and df.count() * len(df.columns) * 8 > WRITTEN_BYTES
    return C.deduplicate(compiled_apart(df) if large else materialize(df), by="digest", write_moved=True)


def clean(
    df: DataFrame, spec: TableSpec, impute_exact: bool = True, checkpoint: bool = True, fit_on: str = "all", unseen: str = "keep"
) -> Cleaned:
    """Cast -> dedup -> fit a :class:`Cleaner` (medians, constants, categories) -> apply it.  Returns the cleaned frame plus the
    reports (uncastable values, profile afterwards) as lazy DataFrames and the fitted cleaner.

    ``fit_on="train"`` learns on the training half of the split by ``spec.key`` only (D15) and applies to all rows; ``"all"`` is the
    table-level cleaning of the reference.  With ``checkpoint`` the cast table, with each row's half where the training half is learned
    from, is written once to the shared checkpoint folder, if it is not too large (:func:`distinct_written`); de-duplication then moves and
    writes only rows that repeat.
    """
    if fit_on not in ("all", "train"):
        raise ValueError(f"unknown fit_on {fit_on!r}")
    uncastable = None
    if spec.schema is not None:
        uncastable = profile_uncastable(df, spec.schema)
        df = C.cast_to_schema(df, spec.schema)
    df = compile_wide(df)
    if checkpoint:
        halved = distinct_written(df if fit_on == "all" else assign_split(df, spec.key, spec.split_ratio, spec.seed, HALF))
        df = halved.drop(HALF)
        learn = df if fit_on == "all" else halved.where(F.col(HALF) == "train").drop(HALF)
    else:
        df = C.deduplicate(df)
        learn = df if fit_on == "all" else split(df, spec.key, spec.split_ratio, spec.seed)[0]
    model = cleaner_for(df, spec, "median" if impute_exact else "approx_median", unseen).fit(learn)
    done = model.transform(df)
    return Cleaned(done, uncastable, model.constants, model)


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    label_col: str
    features: list[str]
    indexer: StringIndexerModel
    weights: DataFrame
    importance: DataFrame | None = None
    categoricals: list[str] = field(default_factory=list)
    invalid: str = "error"
    skipped: DataFrame | None = None


def prepare(
    df: DataFrame,
    spec: TableSpec,
    select_n: int | None = 50,
    weight_col: str = "class_weight",
    select_weighted: bool = False,
    checkpoint: bool = True,
    partitions: int | None = None,
    categoricals: str = "drop",
    invalid: str = "error",
) -> Prepared:
    """Drop -> cast features -> split by key -> index label (fit on train) -> class weights (from
    train) -> top-N features by forest importance (fitted on train).

    ``categoricals="encode"`` keeps the categorical columns as features: they compete for the top N as columns and are encoded by every
    model's own stages; ``"drop"`` leaves them out.  ``invalid="skip"`` leaves rows with a null or NaN number out of fits and scores
    and counts them by half (``skipped``, lazy: ``split, n_rows, n_invalid``).

    With ``checkpoint`` the narrow modelling table (key, label, numeric features, half) is written once to
    the shared checkpoint folder: the label index, the weights, the selection forest and every config
    fit then read it instead of recomputing features from the source (for text input, a re-read of
    every whole text per fit), and a lost executor re-reads it rather than the lineage.

    Rows without a label: a null text label becomes the class ``unknown``; rows with a null numeric label are
    left out, as there is nothing to learn from or to score them against.

    The table keeps the input's partitioning (no shuffle), as the written table is split anew when read;
    ``partitions`` spreads it round-robin over so many instead.
    """
    if spec.key is None:
        raise ValueError("prepare needs spec.key for a reproducible split")
    if categoricals not in ("drop", "encode"):
        raise ValueError(f"unknown categoricals {categoricals!r}")
    cats = [c for c in spec.categoricals if c in df.columns and c not in spec.drop] if categoricals == "encode" else []
    features = spec.feature_columns(C.drop_columns(df, spec.drop + spec.categoricals).columns)
    df = C.cast_columns(df, features, "double").select(spec.key, spec.label, *features, *cats)
    if isinstance(df.schema[spec.label].dataType, T.StringType):
        df = C.fill_category(df, [spec.label], "unknown")
    else:
        df = df.where(qcol(spec.label).isNotNull())
    if partitions:
        df = df.repartition(partitions)
    df = compile_wide(df)
    if checkpoint:
        halved = materialize(assign_split(df, spec.key, spec.split_ratio, spec.seed, HALF))
        df = halved.drop(HALF)
        train, test = (halved.where(F.col(HALF) == half).drop(HALF) for half in ("train", "test"))
    else:
        train, test = split(df, spec.key, spec.split_ratio, spec.seed)
    skipped = invalid_rows(df, spec, features) if invalid == "skip" else None
    label_col = f"{spec.label}_index"
    indexer = fit_indexer(train, [spec.label], "error", output_cols=[label_col])
    train = indexer.transform(train)
    test = with_handle_invalid(indexer, "keep").transform(test)
    weights = class_weights(train, label_col)
    train = with_class_weight(train, label_col, weight_col, weights=weights)
    importance, weight = None, weight_col if select_weighted else None
    if select_n is not None and (cats or invalid != "error"):
        features, cats, importance = select_top_columns(train, features, cats, label_col, select_n, weight, invalid)
    elif select_n is not None:
        features, importance = select_top_features(train, features, label_col, n=select_n, weight=weight)
    return Prepared(train, test, label_col, features, indexer, weights, importance, cats, invalid, skipped)


def invalid_rows(df: DataFrame, spec: TableSpec, features: Sequence[str]) -> DataFrame:
    """``split, n_rows, n_invalid``: per half its rows and those with a number that assembly calls invalid (null or NaN)."""
    bad = F.greatest(F.lit(False), F.lit(False), *(is_missing(qcol(c), df.schema[c].dataType) for c in features))
    halves = assign_split(df, spec.key, spec.split_ratio, spec.seed).fillna("test", ["split"])
    return halves.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_invalid"))


@dataclass
class RunResult:
    prepared: Prepared
    scores: DataFrame
    models: dict
    explained_variance: DataFrame | None = None
    classes: DataFrame | None = None
    sizes: DataFrame | None = None
    importances: dict[str, DataFrame] = field(default_factory=dict)
    column_importances: dict[str, DataFrame] = field(default_factory=dict)
    cleaned: Cleaned | None = None


def run(
    df: DataFrame,
    spec: TableSpec,
    configs: Sequence[ForestConfig] | None = None,
    select_n: int | None = 50,
    metrics: Sequence[str] = ("weightedPrecision", "f1"),
    weighted: bool = True,
    categoricals: str = "drop",
    invalid: str = "error",
    parallelism: int = 1,
) -> RunResult:
    """Prepare, then compare the configurations on the same split; scores as one DataFrame.

    ``weighted=False`` fits without class weights; ``categoricals`` and ``invalid`` as in :func:`prepare`; ``parallelism`` configurations
    are fitted at once.  The result also holds the class distribution of the training rows, the split sizes and each fitted
    configuration's importances by vector slot and by input column (through the loadings where PCA stands between).
    """
    prepared = prepare(df, spec, select_n=select_n, categoricals=categoricals, invalid=invalid)
    configs = list(configs) if configs is not None else default_configs()
    scores, models = compare_configs(
        prepared.train, prepared.test, configs, prepared.features, prepared.label_col,
        weight="class_weight" if weighted else None, metrics=metrics, cache=False,
        categoricals=prepared.categoricals, invalid=invalid, parallelism=parallelism,
    )
    spark, ev, importances, by_column = df.sparkSession, None, {}, {}
    for cfg in configs:
        model = models.get(cfg.name)
        if model is None:
            continue
        slots = [slot for slot, _ in slot_sources(model)]
        if cfg.pca_k:
            ev = explained_variance(spark, model.stages[-2])
            importances[cfg.name] = backproject_importance(spark, model.stages[-2], model.stages[-1], slots)
        else:
            importances[cfg.name] = importance_table(spark, model.stages[-1].featureImportances.toArray().tolist(), slots)
        by_column[cfg.name] = column_importance(spark, model)
    halves = [part.select(F.lit(name).alias("split")) for name, part in (("train", prepared.train), ("test", prepared.test))]
    sizes = split_sizes(halves[0].unionByName(halves[1]))
    return RunResult(prepared, scores, models, ev, class_distribution(prepared.train, spec.label), sizes, importances, by_column)


def run_raw(
    raw: DataFrame | str,
    spec: TableSpec,
    configs: Sequence[ForestConfig] | None = None,
    select_n: int | None = 50,
    sep: str = "\t",
    unseen: str = "keep",
    **kw,
) -> RunResult:
    """E4 from the raw table (or the path of a delimited file) to scores: read as text -> normalise -> cast -> dedup -> learn the
    cleaning on the training half -> clean both halves -> :func:`run` with the categories encoded."""
    if isinstance(raw, str):
        raw = read_delimited(SparkSession.getActiveSession(), raw, sep, infer=False)
    cleaned = clean(normalize(raw, spec), spec, fit_on="train", unseen=unseen)
    result = run(cleaned.df, spec, configs, select_n, **({"categoricals": "encode"} | kw))
    result.cleaned = cleaned
    return result

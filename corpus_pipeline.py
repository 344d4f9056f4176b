"""Corpus pipeline: the training-data operators in a row, each stage on all that the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns documents (the last: their tokens); :func:`run` writes each result as
Parquet in the shared folder and reads it again.  Extra columns are passed on; an empty table passes through
every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsift.llm.bpe import encode_texts
from tabsift.llm.common import join_hot
from tabsift.llm.langid import fit_language_model, keep_identified
from tabsift.llm.line_dedup import line_dedup
from tabsift.llm.queries import mixture, table, training
from tabsift.llm.simhash import row_key, simhash_survivors
from tabsift.session import materialize

SHINGLE, MAX_BITS = 3, 2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null texts, texts without a letter) go."""
    return keep_identified(docs, fit_language_model(training(docs)))


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go out of its texts; ``n_chars`` follows.  No document goes: one left without lines has
    an empty text.  Copies of a text count once, so they reach the near-dedup with their text."""
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    done = line_dedup(docs, "doc_id", F.col("source"), F.col("text"), carry=rest, copies_once=True)
    cells = {c: F.col(f"row.{c}") for c in rest} | {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return done.select(*(cells[c].alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one document stays: the one with the smallest id (a null id only if all are
    null), of equal ids the one with the smallest digest of its text; repeated rows once."""
    key = row_key(F.col("doc_id"), F.col("text")).alias("row_key")
    stay, total = simhash_survivors(docs, shingle=SHINGLE, max_bits=MAX_BITS)
    return join_hot(docs.select(F.struct("*").alias("row"), key), stay, "row_key", "rows", total).dropDuplicates(["row_key"]).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target shares of source, language and form; documents of scarce cells come more than once."""
    return mixture(docs, with_row=True).where("kept").select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) of each document, and digests of them and of their decoding."""
    return encode_texts(docs, outputs=("ids",)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", drop_site_lines),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mix),
    ("bpe", tokenize),
]

#: Model-based and fingerprint stages have no SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in os.environ.get("PYTHONPATH", "").split(":"):
    os.environ["PYTHONPATH"] = ":".join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])
sys.path.insert(0, ROOT)

import pytest  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(spark, sf, n=None):
    """(doc_id, text) of the documents table."""
    t = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    return [tuple(r) for r in (t.limit(n) if n else t).collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with the awkward cases, and extra columns named like the operators' own."""
    passage = "one passage that stands in several texts and is longer than two hundred bytes so that it must be found " * 3
    rows = [
        (1, None),
        (2, ""),
        (3, "   \n\t "),
        (4, "x"),
        (5, "12345 67 !!"),
        (6, "Same text twice"),
        (7, "Same text twice"),
        (8, "same text twice"),
        (9, "ab" * 3000),
        (10, "word " * 4000),
        (11, "intro a " + passage + " end one"),
        (12, "another start " + passage + " other end"),
        (13, passage),
        (14, "日本語のテキスト " * 40),
        (15, "日本語のテキスト " * 40 + "!"),
        (16, "emoji 😀 and accents é ü ß, " * 20),
        (17, "nothing special here at all"),
        (17, "nothing special here at all"),
        (18, "tail  double  spaces  and   odd ones <|endoftext|> in <|endoftext|><|endoftext|>"),
        (19, "z" * 20000 + " " + "z" * 20000),
        (2**40, "Same text twice"),
    ]
    extra = ["a", "row", "fp", "rows", "component", "chunk", "block", "page", "cell", "tokens"]
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
         T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in extra]
    )
    langs = ["en", "de", None]
    return spark.createDataFrame(
        [(i, t, langs[i % 3], None if i == 4 else f"s{i % 2}", len(t or ""), *("clash" for _ in extra)) for i, t in rows], schema
    )


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def odder(spark, odd):
    """``odd`` twice over, with rows of null ids, and a row that is null throughout."""
    nulls = [(None, t, "en", None, None, *("clash" for _ in odd.columns[5:])) for t in ("Same text twice", "another text", "another text", None)]
    return odd.unionByName(odd.where("doc_id < 12")).unionByName(spark.createDataFrame([*nulls, tuple([None] * len(odd.columns))], odd.schema))

"""Inputs derived from the driver's tables, each with its DuckDB twin.

The driver tables are clean (no nulls, sentinels or non-finite values), so dirty data is *derived by
expression* from them; the same expression is given as SQL so oracle queries read exactly the same
rows.  Everything here is a projection of a whole table: no rows are filtered or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsift.functions.exprs import count_substring


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------ documents: counting features

# (feature name, substring counted over the whole text)
DOC_COUNTS: tuple[tuple[str, str], ...] = (
    ("f_spaces", " "),
    ("f_dots", "."),
    ("f_e", "e"),
    ("f_e_grave", "è"),
    ("f_a_uml", "ä"),
    ("f_th", "th"),
    ("f_n_tilde", "ñ"),
    ("f_ou", "ou"),
)
DOC_FEATURES: tuple[str, ...] = ("f_len", *[n for n, _ in DOC_COUNTS], "n_chars")


def document_features(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, <DOC_FEATURES>`` -- language-revealing letter counts over each whole text."""
    text = F.col("text")
    cols = [F.col("doc_id"), F.col("lang"), F.length(text).cast("bigint").alias("f_len")]
    cols += [count_substring(text, s).alias(n) for n, s in DOC_COUNTS]
    cols.append(F.col("n_chars").cast("bigint").alias("n_chars"))
    return docs.select(*cols)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def document_features_sql() -> str:
    parts = ["doc_id", "lang", "CAST(length(text) AS BIGINT) AS f_len"]
    for n, s in DOC_COUNTS:
        parts.append(f"CAST((length(text) - length(replace(text, {_sql_str(s)}, ''))) // {len(s)} AS BIGINT) AS {n}")
    parts.append("CAST(n_chars AS BIGINT) AS n_chars")
    return "SELECT " + ", ".join(parts) + " FROM documents"


# ------------------------------------------------------------------ orders, dirtied by expression

# m = (o_orderkey * 7 + o_custkey) mod 20 picks which defect a row gets.
#   status_txt  text category: 0 null, 1 '-', 2 'nan', 6 'null', 7 'NULL', else o_orderstatus (upper case)
#   priority    text category: 3 null, else o_orderpriority
#   qty_txt     int as text:   0 null, 1 '-', 2 'nan', 3 'abc', else o_custkey
#   price_txt   double as text: 1 '-', 3 'abc', 8 'nan', else o_totalprice
#   price_dbl   double: 0 null, 4 NaN, 5 +Inf, 8 -Inf, 9 -o_totalprice, else o_totalprice
#   cust_int    int: 0 null, else o_custkey
#   const_dbl   7.0 everywhere;  empty_dbl null everywhere
def dirty_orders(orders: DataFrame) -> DataFrame:
    m = F.pmod(F.col("o_orderkey") * F.lit(7) + F.col("o_custkey"), F.lit(20))

    def case(pairs, other):
        expr = None
        for k, v in pairs:
            expr = F.when(m == k, v) if expr is None else expr.when(m == k, v)
        return expr.otherwise(other)

    null_s = F.lit(None).cast("string")
    null_d = F.lit(None).cast("double")
    price = F.col("o_totalprice")
    return orders.select(
        F.col("o_orderkey"),
        case([(0, null_s), (1, F.lit("-")), (2, F.lit("nan")), (6, F.lit("null")), (7, F.lit("NULL"))],
             F.col("o_orderstatus")).alias("status_txt"),
        case([(3, null_s)], F.col("o_orderpriority")).alias("priority"),
        case([(0, null_s), (1, F.lit("-")), (2, F.lit("nan")), (3, F.lit("abc"))],
             F.col("o_custkey").cast("string")).alias("qty_txt"),
        case([(1, F.lit("-")), (3, F.lit("abc")), (8, F.lit("nan"))], price.cast("string")).alias("price_txt"),
        case([(0, null_d), (4, F.lit(float("nan"))), (5, F.lit(float("inf"))), (8, F.lit(float("-inf"))), (9, -price)],
             price).alias("price_dbl"),
        case([(0, F.lit(None).cast("int"))], F.col("o_custkey").cast("int")).alias("cust_int"),
        F.lit(7.0).alias("const_dbl"),
        null_d.alias("empty_dbl"),
    )


DIRTY_ORDERS_SQL = """
dirty_orders AS (
  SELECT
    o_orderkey,
    CASE WHEN m = 0 THEN NULL WHEN m = 1 THEN '-' WHEN m = 2 THEN 'nan' WHEN m = 6 THEN 'null'
         WHEN m = 7 THEN 'NULL' ELSE o_orderstatus END AS status_txt,
    CASE WHEN m = 3 THEN NULL ELSE o_orderpriority END AS priority,
    CASE WHEN m = 0 THEN NULL WHEN m = 1 THEN '-' WHEN m = 2 THEN 'nan' WHEN m = 3 THEN 'abc'
         ELSE CAST(o_custkey AS VARCHAR) END AS qty_txt,
    CASE WHEN m = 1 THEN '-' WHEN m = 3 THEN 'abc' WHEN m = 8 THEN 'nan'
         ELSE CAST(o_totalprice AS VARCHAR) END AS price_txt,
    CASE WHEN m = 0 THEN NULL WHEN m = 4 THEN CAST('NaN' AS DOUBLE) WHEN m = 5 THEN CAST('Infinity' AS DOUBLE)
         WHEN m = 8 THEN CAST('-Infinity' AS DOUBLE) WHEN m = 9 THEN -o_totalprice ELSE o_totalprice END AS price_dbl,
    CASE WHEN m = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS cust_int,
    CAST(7.0 AS DOUBLE) AS const_dbl,
    CAST(NULL AS DOUBLE) AS empty_dbl
  FROM (SELECT *, (o_orderkey * 7 + o_custkey) % 20 AS m FROM orders)
)
"""

# declared types of the text columns of dirty_orders
DIRTY_SCHEMA = T.StructType([
    T.StructField("qty_txt", T.IntegerType()),
    T.StructField("price_txt", T.DoubleType()),
])


# ------------------------------------------------------------------ lineitem, dirtied by expression

# m = (l_orderkey * 7 + l_linenumber) mod 20 (lineitem has no unique key; rows are compared as a multiset)
#   qty_txt    l_quantity as text: 0 null, 1 '-', 2 'nan', 3 'abc', else the number
#   price_dbl  l_extendedprice: 0 null, 4 NaN, 5 +Inf, else the value
#   flag       l_returnflag: 0 null, else the flag
def dirty_lineitem(lineitem: DataFrame) -> DataFrame:
    m = F.pmod(F.col("l_orderkey") * F.lit(7) + F.col("l_linenumber"), F.lit(20))
    qty = (F.when(m == 0, F.lit(None).cast("string")).when(m == 1, F.lit("-")).when(m == 2, F.lit("nan"))
           .when(m == 3, F.lit("abc")).otherwise(F.col("l_quantity").cast("string")))
    price = (F.when(m == 0, F.lit(None).cast("double")).when(m == 4, F.lit(float("nan")))
             .when(m == 5, F.lit(float("inf"))).otherwise(F.col("l_extendedprice")))
    flag = F.when(m == 0, F.lit(None).cast("string")).otherwise(F.col("l_returnflag"))
    return lineitem.select(
        "l_orderkey", "l_linenumber", qty.alias("qty_txt"), price.alias("price_dbl"), flag.alias("flag"),
        "l_discount", "l_tax",
    )


DIRTY_LINEITEM_SQL = """
dirty_lineitem AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN m = 0 THEN NULL WHEN m = 1 THEN '-' WHEN m = 2 THEN 'nan' WHEN m = 3 THEN 'abc'
         ELSE CAST(l_quantity AS VARCHAR) END AS qty_txt,
    CASE WHEN m = 0 THEN NULL WHEN m = 4 THEN CAST('NaN' AS DOUBLE) WHEN m = 5 THEN CAST('Infinity' AS DOUBLE)
         ELSE l_extendedprice END AS price_dbl,
    CASE WHEN m = 0 THEN NULL ELSE l_returnflag END AS flag,
    l_discount, l_tax
  FROM (SELECT *, (l_orderkey * 7 + l_linenumber) % 20 AS m FROM lineitem)
)
"""

"""Compare a registered Spark query with its DuckDB SQL: columns, row count, order-insensitive values.

Usable from pytest and by hand:  python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


SPARK_FAMILY = {"int": "int32", "smallint": "int32", "tinyint": "int32", "bigint": "int64", "double": "double",
                "float": "float", "string": "string", "boolean": "bool"}
DUCK_FAMILY = {"INTEGER": "int32", "SMALLINT": "int32", "TINYINT": "int32", "BIGINT": "int64", "DOUBLE": "double",
               "FLOAT": "float", "VARCHAR": "string", "BOOLEAN": "bool"}


def compare(spark, con, name, sf_dir):
    from tabsift.plans.registry import ORACLE_SQL, QUERIES

    sdf = QUERIES[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    rel = con.sql(ORACLE_SQL[name])
    d_cols = rel.columns
    d_rows = [tuple(_norm(dict(zip(d_cols, r))[c]) for c in sorted(d_cols)) for r in rel.fetchall()]
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns {sorted(s_cols)} vs {sorted(d_cols)}")
    else:
        s_types = {c: SPARK_FAMILY.get(t, t) for c, t in sdf.dtypes}
        d_types = {c: DUCK_FAMILY.get(str(t), str(t)) for c, t in zip(d_cols, rel.types)}
        diff = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
        if diff:
            problems.append(f"types {diff}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows {len(s_rows)} vs {len(d_rows)}")
    if not problems:
        a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        if diff:
            problems.append(f"{len(diff)} differing rows, e.g. {diff[:2]}")
    return problems


def main(argv):
    from pyspark.sql import SparkSession

    from tabsift.plans.registry import ORACLE_SQL

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(ORACLE_SQL)
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from tabsift.session import checkpoint_dir

    checkpoint_dir(spark)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        t = time.time()
        try:
            p = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            p = [f"error {type(e).__name__}: {str(e)[:300]}"]
        bad += bool(p)
        print(f"{'OK ' if not p else 'BAD'} {n:45s} {time.time() - t:6.2f}s {'; '.join(p)}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")


if __name__ == "__main__":
    main(sys.argv)

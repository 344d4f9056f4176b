"""Benchmark the headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Each timing is the median of $BENCH_REPEATS warm runs (model fits: $BENCH_MODEL_REPEATS) and covers
building the query and running it to completion into Spark's no-op sink (nothing is collected
except tiny results).  ``reference_style`` holds the two-jobs-per-column profile the reference runs
(null count, then sentinel count, for every column), on the 9-column dirty orders and on the
84-column flow records, for comparison with the single-pass ``profile_columns_*`` timings.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
MODEL_REPEATS = int(os.environ.get("BENCH_MODEL_REPEATS", "1"))


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tabsift-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tabsift.session import checkpoint_dir

    checkpoint_dir(spark)
    return spark


def sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats: int) -> float:
    times = []
    for _ in range(repeats):
        t = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t)
    return round(statistics.median(times), 3)


def main() -> None:
    import warnings

    warnings.simplefilter("ignore")
    from pyspark.sql import functions as F

    from tabsift.operators.evaluate import compare_configs
    from tabsift.plans.recipes import prepare
    from tabsift.plans.registry import DOC_SPEC, QUERIES, _flows
    from tabsift.sources.fixtures import dirty_orders, document_features, load_table
    from tabsift.spec import default_configs

    spark = session()
    q = lambda name: (lambda: sink(QUERIES[name](spark, SF_DIR)))

    # warm-up: JVM, codegen and file listing, not timed
    sink(QUERIES["profile_columns_dirty_orders"](spark, SF_DIR))
    sink(QUERIES["class_weights_lang"](spark, SF_DIR))

    results: dict[str, float] = {}
    for name in [
        "profile_columns_dirty_orders",
        "profile_columns_dirty_lineitem",
        "profile_columns_flow_records",
        "profile_uncastable_dirty_orders",
        "constant_columns_dirty_orders",
        "impute_median_dirty_orders",
        "impute_median_dirty_lineitem",
        "clean_dirty_orders",
        "deduplicate_orders",
        "split_orders",
        "class_weights_lang",
        "with_class_weight_lang",
        "index_categories_lang",
        "one_hot_p_type",
        "standardize_part",
        "evaluate_rule_labels",
    ]:
        results[name] = timed(q(name), REPEATS)

    results["select_top_features_lang"] = timed(q("select_top_features_lang"), MODEL_REPEATS)

    prepared = prepare(document_features(load_table(spark, SF_DIR, "documents")), DOC_SPEC, select_n=50)
    for cfg in default_configs():
        def fit_score(cfg=cfg):
            scores, _ = compare_configs(prepared.train, prepared.test, [cfg], prepared.features,
                                        prepared.label_col, "class_weight")
            scores.collect()
        results[f"fit_score_{cfg.name}"] = timed(fit_score, MODEL_REPEATS)
    results["run_lang"] = timed(q("run_lang"), MODEL_REPEATS)

    def per_column_jobs(df):  # the reference's shape: two actions per column
        def go():
            for c in df.columns:
                col = F.col("`" + c + "`")
                df.where(col.isNull()).count()
                df.where(col.cast("string").isin("-", "nan", "null")).count()
        return go

    reference_style = {
        "profile_per_column_jobs_dirty_orders": timed(per_column_jobs(dirty_orders(load_table(spark, SF_DIR, "orders"))), REPEATS),
        "profile_per_column_jobs_flow_records": timed(per_column_jobs(_flows(spark, SF_DIR)), 1),
    }

    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    out = {
        "metric": "total_median_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "reference_style": reference_style,
        "sf": sf,
        "cpus": int(CPUS),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

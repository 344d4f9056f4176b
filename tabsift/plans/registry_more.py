"""Registered queries of fitted cleaning, encoded categories, stored state, verified sources and reports; added to
:mod:`tabsift.plans.registry`."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsift.functions.exprs import qcol
from tabsift.operators import clean as C
from tabsift.operators import profile as P
from tabsift.operators.encode import assemble, category_ranks, index_by_ranks, slot_sources
from tabsift.operators.features import backproject_importance, explained_variance, pca, select_top_features, standardize
from tabsift.operators.fitted import Cleaner, CleanerModel
from tabsift.operators.model import fit_config, forest_of
from tabsift.operators.sketches import quantile_state, rank_of, state_quantiles
from tabsift.operators.split import assign_split, split
from tabsift.plans.bundle import Bundle, run_bundle, score_raw
from tabsift.plans.recipes import clean, cleaner_for, normalize, prepare, run, run_raw
from tabsift.plans.registry import (
    DIRTY_CTE,
    DIRTY_TYPES,
    DOC_SPEC,
    DOCS_CTE,
    SENTINELS_SQL,
    SPLIT_BUCKET_SQL,
    _dirty,
    _docs,
    _doc_train_test,
    _flows,
    _HALVES_SQL,
    clean_sql,
    r6,
    register,
)
from tabsift.session import materialize, scratch_path
from tabsift.sources.delimited import content_digests, scan_delimited, verify_content, write_delimited
from tabsift.sources.fixtures import DIRTY_SCHEMA, DOC_FEATURES, load_table
from tabsift.sources.flows import FLOW_KEY_SQL, flow_expressions
from tabsift.spec import ForestConfig, TableSpec

DIRTY_SPEC = TableSpec(label="status_txt", key="o_orderkey", categoricals=("priority",), schema=DIRTY_SCHEMA, non_negative=("price_dbl",))


# ============================================================== fitted cleaning

_FITTED_SQL = clean_sql(
    DIRTY_CTE, "dirty_orders", "o_orderkey", "status_txt", ("priority",),
    {"qty_txt": "INTEGER", "price_txt": "DOUBLE"},
    {"price_dbl": "DOUBLE", "cust_int": "INTEGER", "const_dbl": "DOUBLE", "empty_dbl": "DOUBLE"},
    non_negative=("price_dbl",),
    learn_on=f"{SPLIT_BUCKET_SQL.format(k='o_orderkey')} < 800",
)


@register("clean_fitted_dirty_orders", _FITTED_SQL)
def q_clean_fitted(spark, sf):
    """Medians, constants and categories are learned on the training half and applied to both."""
    return clean(normalize(_dirty(spark, sf), DIRTY_SPEC), DIRTY_SPEC, fit_on="train").df


@register("clean_fitted_reload_dirty_orders", f"""
WITH {DIRTY_CTE}
SELECT CASE WHEN {SPLIT_BUCKET_SQL.format(k='o_orderkey')} < 800 THEN 'train' ELSE 'test' END AS split, COUNT(*) AS n_rows, COUNT(*) AS n_same
FROM dirty_orders GROUP BY 1
""")
def q_clean_fitted_reload(spark, sf):
    """A saved and reloaded cleaner does to both halves what the fitted one does."""
    table = C.cast_to_schema(normalize(_dirty(spark, sf), DIRTY_SPEC), DIRTY_SCHEMA)
    model = cleaner_for(table, DIRTY_SPEC, unseen="fill").fit(split(table, "o_orderkey")[0])
    path = scratch_path(spark, "cleaner")
    model.write().save(path)
    cells = [qcol(c) for c, _ in DIRTY_TYPES]
    before = model.transform(table).select("o_orderkey", F.struct(*cells).alias("before"))
    after = CleanerModel.load(path).transform(table).select("o_orderkey", F.struct(*cells).alias("after"))
    both = assign_split(before.join(after, "o_orderkey"), "o_orderkey")
    return both.groupBy("split").agg(F.count("*").alias("n_rows"), F.count_if(F.col("before").eqNullSafe(F.col("after"))).alias("n_same"))


@register("fill_unseen_categories_orders", f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'c' || o_custkey END AS customer FROM orders),
known AS (SELECT DISTINCT customer FROM o WHERE {SPLIT_BUCKET_SQL.format(k='o_orderkey')} < 800)
SELECT o_orderkey, CASE WHEN customer IN (SELECT customer FROM known WHERE customer IS NOT NULL) THEN customer ELSE 'unknown' END AS customer FROM o
""")
def q_fill_unseen(spark, sf):
    """Categories by the thousand are learned on the training half; null and unlearned ones become ``unknown`` in both."""
    customer = F.when(F.col("o_orderkey") % 11 != 0, F.concat(F.lit("c"), F.col("o_custkey")))
    table = load_table(spark, sf, "orders").select("o_orderkey", customer.alias("customer"))
    return Cleaner(categoricals=["customer"], unseen="fill").fit(split(table, "o_orderkey")[0]).transform(table)


# ============================================================== categories inside the fitted pipeline

FLOW_NUMBERS = ("flow_duration", "fwd_pkts_tot", "bwd_pkts_tot", "fwd_pkts_per_sec")
FLOW_PART = TableSpec(label="Attack_type", key="flow_id", categoricals=("proto", "service"), numerics=FLOW_NUMBERS)


def _flow_part_sql() -> str:
    named = ", ".join(f"{expr} AS {name}" for name, expr in flow_expressions() if name in ("proto", "service"))
    cats = ", ".join(f"CASE WHEN lower({c}) IN {SENTINELS_SQL} THEN NULL ELSE lower({c}) END AS {c}" for c in ("proto", "service"))
    return f"""f AS (SELECT {FLOW_KEY_SQL} AS flow_id, {cats} FROM (SELECT l_orderkey, l_linenumber, {named} FROM lineitem)),
h AS (SELECT *, CASE WHEN {SPLIT_BUCKET_SQL.format(k='flow_id')} < 800 THEN 'train' ELSE 'test' END AS split FROM f)"""


def _flow_part(spark, sf):
    """Four numbers and both categories of the flow records, cleaned by what the training half teaches."""
    table = normalize(_flows(spark, sf, with_key=True), FLOW_PART).select("flow_id", "Attack_type", *FLOW_NUMBERS, "proto", "service")
    halved = materialize(assign_split(C.cast_columns(table, FLOW_NUMBERS, "double"), "flow_id"))  # several passes read it
    table = halved.drop("split")
    return cleaner_for(table, FLOW_PART).fit(halved.where("split = 'train'")).transform(table)


_CONFIGS = [ForestConfig("raw", num_trees=10, max_depth=5), ForestConfig("pca", scale=True, pca_k=3, num_trees=10, max_depth=5)]


@register("encoded_importances_flow_records", f"""
WITH {_flow_part_sql()},
n AS (SELECT COUNT(DISTINCT COALESCE(proto, 'unknown')) + COUNT(DISTINCT COALESCE(service, 'unknown')) + 4 AS n_slots FROM h WHERE split = 'train')
SELECT config, CAST(6 AS BIGINT) AS n_columns, CAST(2 AS BIGINT) AS n_categorical, n_slots, CAST(1 AS DOUBLE) AS total, CAST(0 AS BIGINT) AS n_negative
FROM n, (VALUES ('raw'), ('pca')) AS c(config)
""")
def q_encoded_importances(spark, sf):
    """Both categories are features: importances by column cover them, come from one slot per category and sum to 1."""
    result = run(_flow_part(spark, sf), FLOW_PART, _CONFIGS, categoricals="encode")
    out = None
    for name, table in result.column_importances.items():
        row = table.agg(
            F.lit(name).alias("config"),
            F.count("*").alias("n_columns"),
            F.count_if(F.col("column").isin("proto", "service")).alias("n_categorical"),
            F.sum("n_slots").cast("bigint").alias("n_slots"),
            r6(F.sum("share")).alias("total"),
            F.count_if(F.col("importance") < 0).alias("n_negative"),
        ).select("config", "n_columns", "n_categorical", "n_slots", "total", "n_negative")
        out = row if out is None else out.unionByName(row)
    return out


@register("encoded_unseen_flow_records", f"""
WITH {_flow_part_sql()}
SELECT split, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE flow_id % 10 = 0) AS n_unseen, CAST(0 AS BIGINT) AS n_unscored FROM h GROUP BY split
""")
def q_encoded_unseen(spark, sf):
    """A category that no training row has is scored like any other, in both halves."""
    prepared = prepare(_flow_part(spark, sf), FLOW_PART, select_n=None, categoricals="encode")
    model = fit_config(prepared.train, _CONFIGS[0], prepared.features, prepared.label_col, "class_weight", prepared.categoricals)
    both = prepared.train.unionByName(prepared.test.withColumn("class_weight", F.lit(None).cast("double")))
    strange = F.col("flow_id") % 10 == 0
    scored = model.transform(both.withColumn("service", F.when(strange, F.lit("never seen")).otherwise(F.col("service"))))
    scored = assign_split(scored, "flow_id")
    bad = F.col("prediction").isNull() | (F.col("prediction") >= len(prepared.indexer.labels))
    return scored.groupBy("split").agg(F.count("*").alias("n_rows"), F.count_if(strange).alias("n_unseen"), F.count_if(bad).alias("n_unscored"))


@register("skipped_rows_dirty_orders", f"""
WITH {DIRTY_CTE}
SELECT CASE WHEN {SPLIT_BUCKET_SQL.format(k='o_orderkey')} < 800 THEN 'train' ELSE 'test' END AS split, COUNT(*) AS n_rows,
  COUNT(*) FILTER (WHERE price_dbl IS NULL OR isnan(price_dbl) OR cust_int IS NULL OR TRY_CAST(qty_txt AS DOUBLE) IS NULL
    OR isnan(TRY_CAST(qty_txt AS DOUBLE))) AS n_invalid
FROM dirty_orders GROUP BY 1
""")
def q_skipped(spark, sf):
    """Rows that a run with ``invalid="skip"`` leaves out, by half."""
    spec = TableSpec(label="status_txt", key="o_orderkey", numerics=("price_dbl", "cust_int", "qty_txt"))
    return prepare(_dirty(spark, sf), spec, select_n=None, invalid="skip").skipped


_DIRTY_SIZES_SQL = f"""sizes AS (SELECT CASE WHEN {SPLIT_BUCKET_SQL.format(k='o_orderkey')} < 800 THEN 'train' ELSE 'test' END AS split, COUNT(*) AS n_rows
  FROM dirty_orders GROUP BY 1)"""
_SMALL = [ForestConfig("raw", num_trees=5, max_depth=4), ForestConfig("scaled", scale=True, num_trees=5, max_depth=4)]


@register("run_raw_checks_dirty_orders", f"""
WITH {DIRTY_CTE}, {_DIRTY_SIZES_SQL}
SELECT config, split, metric, 'ok' AS status, TRUE AS in_range, n_rows FROM sizes,
  (VALUES ('raw'), ('scaled')) AS c(config), (VALUES ('weightedPrecision'), ('f1')) AS m(metric)
""")
def q_run_raw(spark, sf):
    """From the raw table to scores in one call, categories encoded, every row kept."""
    result = run_raw(_dirty(spark, sf), DIRTY_SPEC, _SMALL, parallelism=2)
    scores = result.scores.join(F.broadcast(result.sizes.withColumnRenamed("n", "n_rows")), "split")
    return scores.select("config", "split", "metric", "status", F.col("value").between(0, 1).alias("in_range"), "n_rows")


@register("bundle_scores_dirty_orders", f"""
WITH {DIRTY_CTE}, {_DIRTY_SIZES_SQL}
SELECT config, CAST(SUM(n_rows) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_without_label, TRUE AS skips_finished FROM sizes,
  (VALUES ('raw'), ('scaled')) AS c(config) GROUP BY config
""")
def q_bundle(spark, sf):
    """A raw table scored from a reloaded run; the second call of the run finds its first configuration finished."""
    path, raw = scratch_path(spark, "run"), _dirty(spark, sf)
    first = run_bundle(raw, DIRTY_SPEC, path, _SMALL[:1]).finished()
    run_bundle(raw, DIRTY_SPEC, path, _SMALL)
    bundle, out = Bundle(spark, path), None
    labels = ["f", "o", "p", "unknown"]
    for config in _SMALL:
        scored = score_raw(bundle, raw, DIRTY_SPEC, config.name)
        row = scored.agg(
            F.lit(config.name).alias("config"),
            F.count("*").alias("n_rows"),
            F.count_if(~F.coalesce(F.col("predicted").isin(labels), F.lit(False))).alias("n_without_label"),
            F.lit(first == ["raw"] and bundle.finished() == ["raw", "scaled"]).alias("skips_finished"),
        ).select("config", "n_rows", "n_without_label", "skips_finished")
        out = row if out is None else out.unionByName(row)
    return out


# ============================================================== stored sketches (C9 approximate)

_SKETCHED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey")


@register("sketch_medians_lineitem", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(COUNT({c}) AS BIGINT) AS n, TRUE AS within_bound FROM lineitem" for c in _SKETCHED
))
def q_sketch_medians(spark, sf):
    """One sketch per line number and column, stored in two loads and merged: each median's true rank lies within the bound."""
    lines, path = load_table(spark, sf, "lineitem"), scratch_path(spark, "sketches")
    for load in (F.col("l_linenumber") % 2 == 0, F.col("l_linenumber") % 2 != 0):
        quantile_state(lines.where(load), _SKETCHED, F.col("l_linenumber")).write.mode("append").parquet(path)
    found = rank_of(lines, state_quantiles(spark.read.parquet(path)))
    n, bound = F.col("n"), F.col("bound") * F.col("n") + 1
    within = (F.col("below") <= n / 2 + bound) & (F.col("upto") >= n / 2 - bound)
    return found.select("column", "n", within.alias("within_bound"))


# ============================================================== verified sources (S1, S2, S5), digests (C15), ranks (F1)

_CHANGED = ("c_acctbal", "(row)")


@register("verify_content_customer", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) AS n_rows, COUNT(*) AS n_read, {'FALSE' if c in _CHANGED else 'TRUE'} AS ok FROM customer"
    for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "(row)")
))
def q_verify_content(spark, sf):
    """One changed cell of a written table is found, and its column named."""
    customers, path = load_table(spark, sf, "customer"), scratch_path(spark, "customer-tsv")
    changed = F.when(F.col("c_custkey") == 17, F.col("c_acctbal") + 0.01).otherwise(F.col("c_acctbal"))
    write_delimited(customers.withColumn("c_acctbal", changed), path)
    return verify_content(customers, path)


_LINE = "CASE WHEN p_partkey % 50 = 0 THEN concat_ws(chr(9), p_partkey, p_name) WHEN p_partkey % 50 = 1 THEN concat_ws(chr(9), p_partkey, p_name, p_size, 'more') " \
    "WHEN p_partkey % 50 = 2 THEN concat_ws(chr(9), p_partkey, p_name, 'many') ELSE concat_ws(chr(9), p_partkey, p_name, p_size) END"


@register("scan_rejects_part", f"SELECT {_LINE} AS line FROM part WHERE p_partkey % 50 < 3")
def q_scan_rejects(spark, sf):
    """Rows with a field too few, one too many, or text for a number come back whole, in a table of their own."""
    path = scratch_path(spark, "part-lines")
    load_table(spark, sf, "part").select(F.expr(_LINE.replace("chr(9)", "'\\t'")).alias("value")).write.text(path)
    return scan_delimited(spark, path, schema="p_partkey long, p_name string, p_size int", header=False).rejects.select("line")


@register("scan_accepted_part", "SELECT p_partkey, p_name, p_size FROM part WHERE p_partkey % 50 >= 3")
def q_scan_accepted(spark, sf):
    """The rows beside the rejects, typed."""
    path = scratch_path(spark, "part-lines")
    load_table(spark, sf, "part").select(F.expr(_LINE.replace("chr(9)", "'\\t'")).alias("value")).write.text(path)
    return scan_delimited(spark, path, schema="p_partkey long, p_name string, p_size int", header=False).rows


@register("deduplicate_digest_lineitem", """
WITH l AS (SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem)
SELECT DISTINCT * FROM (SELECT * FROM l UNION ALL SELECT * FROM l WHERE l_orderkey % 5 = 0)
""")
def q_deduplicate_digest(spark, sf):
    lines = load_table(spark, sf, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("string"))
    return C.deduplicate(lines.unionByName(lines.where(F.col("l_orderkey") % 5 == 0)), by="digest")


@register("index_ranks_lineitem", """
WITH r AS (SELECT part, row_number() OVER (ORDER BY n DESC, part) - 1 AS idx FROM
  (SELECT CAST(l_partkey AS VARCHAR) AS part, COUNT(*) AS n FROM lineitem WHERE l_partkey % 7 <> 0 GROUP BY 1))
SELECT l_orderkey, l_linenumber, l_partkey, CAST(COALESCE(idx, (SELECT COUNT(*) FROM r)) AS DOUBLE) AS part_index
FROM lineitem LEFT JOIN r ON CAST(l_partkey AS VARCHAR) = part
""")
def q_index_ranks(spark, sf):
    """Thousands of categories ranked without gathering them; those that were not learned get the index K."""
    lines = load_table(spark, sf, "lineitem")
    ranks = category_ranks(lines.where(F.col("l_partkey") % 7 != 0), "l_partkey")
    return index_by_ranks(lines, "l_partkey", ranks, "part_index").select("l_orderkey", "l_linenumber", "l_partkey", "part_index")


@register("content_digest_orders", "SELECT name AS \"column\", n AS n_rows, TRUE AS same FROM (SELECT COUNT(*) AS n FROM orders), "
          "(VALUES ('o_orderkey'), ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'), ('o_orderpriority'), ('(row)')) AS c(name)")
def q_content_digest(spark, sf):
    """Digests depend on neither order nor partitions."""
    orders = load_table(spark, sf, "orders")
    other = content_digests(orders.repartition(7, "o_custkey").sortWithinPartitions("o_totalprice"))
    both = content_digests(orders).join(F.broadcast(other.select("column", F.col("digest").alias("other"))), "column")
    return both.select("column", "n_rows", (F.col("digest") == F.col("other")).alias("same"))


# ============================================================== reports

_TYPES_SQL = "CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END"


@register("profile_schema_lineitem", f"""
SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS "column", {_TYPES_SQL} AS data_type, TRUE AS nullable
FROM information_schema.columns WHERE table_name = 'lineitem'
""")
def q_profile_schema(spark, sf):
    return P.profile_schema(load_table(spark, sf, "lineitem"))


@register("check_schema_orders", f"""
WITH have AS (SELECT column_name AS name, {_TYPES_SQL} AS type FROM information_schema.columns WHERE table_name = 'orders'),
want AS (SELECT * FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'int'), ('o_clerk', 'string')) AS w(name, type))
SELECT COALESCE(have.name, want.name) AS "column", CASE WHEN have.name IS NULL THEN 'missing' WHEN want.name IS NULL THEN 'extra' ELSE 'type' END AS problem,
  want.type AS expected, have.type AS actual
FROM have FULL JOIN want USING (name) WHERE have.type IS DISTINCT FROM want.type
""")
def q_check_schema(spark, sf):
    from pyspark.sql.types import StructType

    return C.check_schema(load_table(spark, sf, "orders"), StructType.fromDDL("o_orderkey bigint, o_custkey int, o_clerk string"))


@register("feature_columns_lineitem", """
SELECT CAST(row_number() OVER (ORDER BY ordinal_position) - 1 AS INTEGER) AS position, column_name AS "column"
FROM information_schema.columns WHERE table_name = 'lineitem' AND column_name NOT IN ('l_orderkey', 'l_returnflag')
""")
def q_feature_columns(spark, sf):
    lines = load_table(spark, sf, "lineitem")
    return P.profile_schema(lines.select(C.feature_columns(lines, ["l_orderkey", "l_returnflag"]))).select("position", "column")


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("pca_clamped_lineitem", "SELECT CAST(4 AS BIGINT) AS n_components, CAST(1 AS DOUBLE) AS total FROM lineitem HAVING COUNT(*) > 0")
def q_pca_clamped(spark, sf):
    """Ten components asked of four columns give four, which explain everything."""
    vec = assemble(load_table(spark, sf, "lineitem").select(*_MEASURES), _MEASURES)
    ratios = explained_variance(spark, pca(standardize(vec).transform(vec), k=10))
    return ratios.agg(F.count("*").alias("n_components"), r6(F.sum("ratio")).alias("total"))


@register("cumulative_variance_lineitem", "SELECT CAST(4 AS BIGINT) AS n, CAST(4 AS BIGINT) AS n_running_sums, CAST(1 AS DOUBLE) AS last FROM lineitem HAVING COUNT(*) > 0")
def q_cumulative_variance(spark, sf):
    """``cumulative`` is the sum of the ratios so far, each component's by a self-join, and ends at 1."""
    vec = assemble(load_table(spark, sf, "lineitem").select(*_MEASURES), _MEASURES)
    ev = explained_variance(spark, pca(standardize(vec).transform(vec), k=4))
    sofar = ev.select(F.col("component").alias("c"), "cumulative").join(F.broadcast(ev.select("component", "ratio")), F.expr("component <= c"))
    sums = sofar.groupBy("c", "cumulative").agg(F.sum("ratio").alias("sum"))
    return sums.agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("sum") - F.col("cumulative")) < 1e-9).alias("n_running_sums"), r6(F.max("cumulative")).alias("last"))


@register("select_top_features_checks_lang", "SELECT CAST(4 AS BIGINT) AS n_selected, CAST(4 AS BIGINT) AS n_best, TRUE AS all_ranked FROM documents HAVING COUNT(*) > 0")
def q_select_top_checks(spark, sf):
    """The features selected are those with the four highest importances, and every feature has a rank."""
    p = _doc_train_test(spark, sf)
    top, table = select_top_features(p.train, p.features, p.label_col, n=4, num_trees=10)
    rows = sorted(table.collect(), key=lambda r: (-r["importance"], r["feature"]))  # one row per feature
    best = {r["feature"] for r in rows[:4]}
    return spark.range(1).select(
        F.lit(len(top)).cast("bigint").alias("n_selected"),
        F.lit(len(best & set(top))).cast("bigint").alias("n_best"),
        F.lit([r["rank"] for r in rows] == list(range(1, len(DOC_FEATURES) + 1))).alias("all_ranked"),
    )


@register("backproject_checks_lang", f"SELECT CAST({len(DOC_FEATURES)} AS BIGINT) AS n_features, CAST({len(DOC_FEATURES)} AS BIGINT) AS n_equal FROM documents HAVING COUNT(*) > 0")
def q_backproject_checks(spark, sf):
    """Each feature's value is the sum of its absolute loadings times the components' importances, worked out again here."""
    p = _doc_train_test(spark, sf)
    cfg = ForestConfig("pca", scale=True, pca_k=4, num_trees=10)
    model = fit_config(p.train, cfg, p.features, p.label_col, "class_weight")
    pc, imp = model.stages[-2].pc.toArray(), forest_of(model).featureImportances.toArray()
    want = {name: float(sum(abs(pc[i, j]) * imp[j] for j in range(len(imp)))) for i, (name, _) in enumerate(slot_sources(model))}
    pairs = F.create_map(*(F.lit(x) for pair in want.items() for x in pair))
    got = backproject_importance(spark, model.stages[-2], forest_of(model), p.features)
    return got.agg(F.count("*").alias("n_features"), F.count_if(F.abs(pairs[F.col("feature")] - F.col("importance")) < 1e-9).alias("n_equal"))


@register("prepare_halves_lang", f"""
WITH {DOCS_CTE},
h AS (SELECT *, CASE WHEN {SPLIT_BUCKET_SQL.format(k='doc_id')} < 800 THEN 'train' ELSE 'test' END AS split FROM docs),
m AS (SELECT lang AS v, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, lang) - 1 AS DOUBLE) AS idx FROM h WHERE split = 'train' GROUP BY lang)
SELECT split, doc_id, lang, COALESCE(idx, (SELECT COUNT(*) FROM m)) AS lang_index, {", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in DOC_FEATURES)}
FROM h LEFT JOIN m ON lang = v
""")
def q_prepare_halves(spark, sf):
    p = prepare(_docs(spark, sf), DOC_SPEC, select_n=None)
    parts = [half.select(F.lit(name).alias("split"), "doc_id", "lang", p.label_col, *p.features) for name, half in (("train", p.train), ("test", p.test))]
    return parts[0].unionByName(parts[1])


@register("run_reports_lang", f"""
WITH {_HALVES_SQL}
SELECT 'rows' AS report, split AS key, CAST(COUNT(*) AS DOUBLE) AS value FROM halves GROUP BY split
UNION ALL SELECT 'class', lang, CAST(COUNT(*) AS DOUBLE) FROM halves WHERE split = 'train' GROUP BY lang
UNION ALL SELECT 'features', config, {len(DOC_FEATURES)} FROM (VALUES ('raw'), ('pca')) AS c(config)
""")
def q_run_reports(spark, sf):
    """The reports of a run: rows by half, training rows by class, features by configuration."""
    result = run(_docs(spark, sf), DOC_SPEC, _CONFIGS)
    value = F.col("n").cast("double").alias("value")
    out = result.sizes.select(F.lit("rows").alias("report"), F.col("split").alias("key"), value)
    out = out.unionByName(result.classes.select(F.lit("class").alias("report"), F.col("lang").alias("key"), value))
    for name, table in result.importances.items():
        counted = table.agg(F.count("*").alias("n"))
        out = out.unionByName(counted.select(F.lit("features").alias("report"), F.lit(name).alias("key"), value))
    return out

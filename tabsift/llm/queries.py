"""The registered ``opN_*`` queries: thin views of the operators over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_texts
from .common import lang_mod
from .embedding_dedup import embedding_dedup
from .exact_dedup import exact_dedup
from .interpolation import DELETED, score_texts
from .langid import fit_language_model, identify
from .lexical import lexical_search
from .line_dedup import html_lines, host_of, line_dedup
from .merkle import fold, leaf_text, merkle_manifest
from .mixing import mix_sources, text_kind
from .packing import pack_tokens
from .repeats import remove_repeats
from .simhash import simhash_dedup
from .toxicity import fit_toxicity, toxicity

HELD_OUT = 2
THRESHOLD = 0.3



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def training(docs: DataFrame) -> DataFrame:
    return docs.where(lang_mod(F.col("doc_id")) != HELD_OUT)


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_language_model(training(docs))
    return identify(docs, model).select(
        "doc_id", (lang_mod(F.col("doc_id")) == HELD_OUT).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = fit_toxicity(training(docs).select("doc_id", "text"), training(labels), docs)
    return toxicity(docs, model).select(
        "doc_id",
        (lang_mod(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def mixture(docs: DataFrame, with_row: bool = False) -> DataFrame:
    return mix_sources(
        docs,
        {"source": F.col("source"), "lang": F.col("lang"), "topic": text_kind(F.col("text"))},
        {"source": 0.5, "lang": 0.7, "topic": 0.8},
        with_row=with_row,
        copies=with_row,
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), outputs=()).select(
        "doc_id", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_sha256", "decoded_sha256"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    done = line_dedup(pages, "page_id", host_of(F.col("url")), html_lines(F.col("html")))
    return done.select(F.col("page").alias("page_id"), "host", "n_lines", "n_dropped", "text")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    held_out = F.coalesce(number % 7 == HELD_OUT, F.lit(False))
    scored = score_texts(table(spark, sf_dir, "documents"), number % 7 != HELD_OUT, F.floor(number / 7) % DELETED == 0)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fields = table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = [F.col(c) if c != "n_chars" else F.col(c).cast("decimal(20,0)") + 1 for c in fields]
    forged = F.when(tampered & F.col("n_chars").isNotNull(), F.sha2(leaf_text(more), 256))
    manifest = merkle_manifest(docs, fields, carry={"forged": forged}, carry_schema="forged string")
    proved = manifest.withColumn("folded_root", fold(F.coalesce("forged", "leaf"), F.col("sides"), F.col("siblings")))
    return proved.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeats": op1_repeats,
    "op2_language_id": op2_language_id,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_simhash": op4_simhash,
    "op5_embeddings": op5_embeddings,
    "op6_toxicity": op6_toxicity,
    "op7_mixing": op7_mixing,
    "op8_bpe": op8_bpe,
    "op9_packing": op9_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_merkle_manifest": op13_merkle_manifest,
}

def _mixing_sql() -> str:
    """Proportional fitting written out step by step, with sweeps enough for errors below 1e-12."""
    margins = {"source": 0.5, "lang": 0.7, "topic": 0.8}
    none = "(none)"
    steps = [
        f"""d as (select doc_id, coalesce(source, '{none}') as source, coalesce(lang, '{none}') as lang,
        case when contains(text, ' | ') then 'table' when contains(text, '!!') then 'shout'
             when coalesce(length(text), 0) < 500 then 'short' when length(text) >= 5000 then 'long' else 'prose' end as topic,
        coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\x0B]+')), 0)::bigint as n_tokens from documents)""",
        "c as (select source, lang, topic, sum(n_tokens)::double as tokens from d group by all)",
    ]
    for m, power in margins.items():
        steps.append(f"p_{m} as (select {m}, pow(sum(tokens), {power}) as power from c group by {m} having sum(tokens) > 0)")
        steps.append(f"t_{m} as (select {m}, power / (select sum(power) from p_{m}) as target from p_{m})")
    steps.append("f0 as (select *, 1.0::double as factor from c)")
    last = 0
    for _ in range(30):
        for m in margins:
            steps.append(
                f"""f{last + 1} as materialized (select x.source, x.lang, x.topic, x.tokens, x.factor * coalesce(s.step, 0) as factor from f{last} x
                join (select {m}, max(target) * (select sum(tokens) from c) / nullif(sum(tokens * factor), 0) as step
                      from f{last} left join t_{m} using ({m}) group by {m}) s using ({m}))"""
            )
            last += 1
    return f"""with {", ".join(steps)},
    g as (select source, lang, topic, case when tokens > 0 then round(factor, 6) else 1.0 end as factor from f{last}),
    r as (select doc_id, source, lang, topic, n_tokens, factor, least(1.0, factor) as probability,
          ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':42'), 1, 13))::bigint / 4503599627370496.0 as u
          from d join g using (source, lang, topic))
    select doc_id, source, lang, topic, n_tokens, factor, probability, u < probability as kept,
           case when probability > 0 then round(factor / probability, 9) else 0.0 end as weight from r"""


_LINES_SQL = r"""
with p as (
  select page_id, coalesce(lower(regexp_extract(url, '^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)', 1)), '') as host,
    regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', '', 'g'),
      '(?i)</?(?:p|br|li|ul|ol|div|h[1-6]|nav|article|title|head|body|html|table|tr|td|th|section|header|footer)(?:[^a-z1-6>][^>]*)?>', chr(10), 'g'),
      '<[^>]*>', '', 'g') as text
  from pages),
l as (
  select page_id, host, pos, line, regexp_replace(line, '^[ 	
]+|[ 	
]+$', '', 'g') as k
  from (select page_id, host, generate_subscripts(lines, 1) as pos, unnest(lines) as line
        from (select page_id, host, string_split(coalesce(text, ''), chr(10)) as lines from p))),
n as (select host, count(*) as n_pages from p group by host),
bad as (
  select host, k from (select host, k, count(distinct page_id) as n_with from l where k <> '' group by host, k) join n using (host)
  where n_with >= 3 and n_with > n_pages * 0.1::double),
m as (select l.*, bad.k is not null as gone from l left join bad on l.host = bad.host and l.k = bad.k),
r as (
  select page_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
         string_agg(line, chr(10) order by pos) filter (not gone) as kept from m group by page_id)
select p.page_id, nullif(p.host, '') as host, case when p.text is null then 0 else n_lines end::bigint as n_lines, n_dropped::bigint as n_dropped,
       case when p.text is null then null when n_dropped = 0 then p.text else coalesce(kept, '') end as text
from p join r using (page_id)
"""

_SEARCH_SQL = r"""
with it as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
d as (select row_number() over () as row, doc_id, text from documents),
w as (
  select row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
len as (select row, count(*) as n from w group by row),
tot as (select count(*) as docs, sum(n)::bigint as terms from len),
tf as (select row, doc_id, term, count(*) as tf from w where term in (select term from it) group by all),
weight as (select term, floor(1000 * ln((2 * (select docs from tot) + 2)::double / (2 * count(*) + 1)))::bigint as w from tf group by term),
m as (select row, 100 - 50 + (50 * n * (select docs from tot)) // (select terms from tot) as m from len),
s as (
  select item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
  from tf join weight using (term) join m using (row) join it using (term) group by all),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= 50
"""

_MERKLE_SQL = r"""
with recursive v as (
  select *, sha256(head || coalesce(octet_length(encode(n_chars::varchar)) || ':' || n_chars, '-') || tail) as leaf,
    case when n_chars is not null and xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint), lambda crc, c:
        list_reduce(range(8), lambda r, i: case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end, xor(crc, c)), 4294967295), 4294967295) % 7 = 0
      then sha256(head || length((n_chars + 1)::varchar) || ':' || (n_chars + 1) || tail) end as forged
  from (select doc_id, lang, n_chars,
      coalesce(length(doc_id::varchar) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
        || coalesce(octet_length(encode(lang)) || ':' || lang, '-') as head,
      coalesce(octet_length(encode(text)) || ':' || text, '-') as tail from documents)),
l as (
  select row_number() over () as row, doc_id, coalesce('+' || lang, '') as g, leaf, forged,
    row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as n from v),
t as (
  select g, 0 as lvl, pos, leaf as h, n from l
  union all select g, lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (max(n) + 1) // 2 from t where n > 1 group by g, lvl, pos // 2),
s as (select g, h, row_number() over (order by g) - 1 as pos, count(*) over () as n from t where n = 1),
u as (
  select 0 as lvl, pos, h, n from s
  union all select lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (max(n) + 1) // 2 from u where n > 1 group by lvl, pos // 2),
path as (
  select row, a.lvl as step, case when b.h is null then 'N' when (l.pos >> a.lvl) % 2 = 1 then 'L' else 'R' end as side, coalesce(b.h, '') as h
  from l join (select distinct g, lvl from t where n > 1) a using (g)
  left join t b on b.g = l.g and b.lvl = a.lvl and b.pos = xor(l.pos >> a.lvl, 1)
  union all
  select row, 100 + a.lvl, case when b.h is null then 'N' when (s.pos >> a.lvl) % 2 = 1 then 'L' else 'R' end, coalesce(b.h, '')
  from l join s using (g) cross join (select distinct lvl from u where n > 1) a
  left join u b on b.lvl = a.lvl and b.pos = xor(s.pos >> a.lvl, 1)),
w as (select row, string_agg(h, '' order by step) as siblings, list(side || h order by step) as steps from path group by row),
f as (
  select doc_id, leaf, s.h as subroot, (select h from u where n = 1) as root, sha256(coalesce(siblings, '')) as proof_sha256,
    list_reduce(coalesce(steps, []), lambda node, x: case x[1] when 'L' then sha256(x[2:] || node) when 'R' then sha256(node || x[2:])
      else sha256(node) end, coalesce(forged, leaf)) as folded_root
  from l join s using (g) left join w using (row))
select *, folded_root = root as verified from f
"""

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))
""",
    "op5_embeddings": """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.9),
reach as (select vec_id as node, vec_id as other from embeddings union select r.node, l.b from reach r join links l on l.a = r.other),
low as (select node, min(other) as component_id from reach group by node),
degree as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from embeddings join low on node = vec_id left join degree on a = vec_id
""",
    "op7_mixing": _mixing_sql(),
    "op10_line_dedup": _LINES_SQL,
    "op11_lexical_search": _SEARCH_SQL,
    "op13_merkle_manifest": _MERKLE_SQL,
}

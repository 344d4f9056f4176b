"""Line dedup by site-relative frequency, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import HOT_PARTS, join_hot

#: A line is boilerplate on a site if it stands on more than MAX_RATIO of the site's pages and on at least MIN_PAGES.
MAX_RATIO, MIN_PAGES = 0.1, 3


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL: what follows ``//`` up to the next ``/ ? # :`` (user names left out); null without one."""
    host = F.lower(F.regexp_extract(url, r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def boilerplate_lines(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, line_key, n_with, n_pages`` of the lines above the ratio, from ``pages(page, host, lines)``.

    A line counts once per page.  White-space-only lines have no key and are never boilerplate.  The key is the MD5 of the
    trimmed line; counts are partially aggregated before the shuffle, so a line that stands on
    a third of all pages arrives as one row per task.
    """
    totals = materialize(pages.groupBy("host").agg(F.count("*").alias("n_pages")))
    keys = F.array_distinct(F.filter("keys", lambda k: k.isNotNull()))
    seen = pages.select("host", F.explode(keys).alias("line_key")).groupBy("host", "line_key").agg(F.count("*").alias("n_with"))
    often = seen.where(F.col("n_with") >= min_pages)
    n_pages = totals.agg(F.coalesce(F.sum("n_pages"), F.lit(0))).first()[0]
    sized = totals.withColumn("size", F.col("n_pages"))
    return (
        join_hot(often, sized, "host", "size", n_pages)
        .select("host", "line_key", "n_with", "n_pages")
        .where(F.col("n_with") > F.col("n_pages") * F.lit(max_ratio))
    )


def html_lines(html: Column) -> Column:
    """Text of an HTML page with a line for each block: scripts, styles and comments go, block tags and ``<br>`` end a line."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->", "")
    cut = F.regexp_replace(bare, r"(?i)</?(?:p|br|li|ul|ol|div|h[1-6]|nav|article|title|head|body|html|table|tr|td|th|section|header|footer)(?:[^a-z1-6>][^>]*)?>", "\n")
    return F.regexp_replace(cut, r"<[^>]*>", "")


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """MD5 of the line without surrounding white space; null for a blank line."""
    trimmed = F.regexp_replace(line, r"^[ \t\r\f\x0B]+|[ \t\r\f\x0B]+$", "")
    return F.when(trimmed != "", F.unhex(F.md5(trimmed.cast("binary"))))


def line_dedup(
    pages: DataFrame,
    id_col: str,
    host: Column,
    text: Column,
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    carry: list[str] | None = None,
    copies_once: bool = False,
) -> DataFrame:
    """``page, host, text, n_lines, n_dropped`` (and ``row``, a struct of the columns in ``carry``); one row per input row,
    ``text`` without its boilerplate lines.

    A page is an input row, so a row that repeats counts as another page of its site; with ``copies_once``, all rows of a
    site with the same text count as one page (in a line's pages and the site's alike).  Pages with a null or empty host form a
    site of their own.  Null text counts as empty and comes back null; a page left without lines has
    empty text.  An empty table gives no rows; other columns are ignored.

    A line of a hot site is a key of its own (site and line), so sites are never gathered; hot lines (over one part
    in 200 of all line rows, hence fewer than 200 of them) are broadcast, all other keys are shuffled.
    """
    base = pages.select(F.col(id_col).alias("page"), F.coalesce(host, F.lit("")).alias("host"), text.alias("text"), *([F.struct(*carry).alias("row")] if carry else []))
    content = F.concat_ws("|", F.coalesce(F.col("page").cast("string"), F.lit("")), "host", "text")
    base = base.withColumn("row_key", F.unhex(F.md5(content.cast("binary"))))
    digest = [F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("digest")] if copies_once else []
    keyed = base.select("row_key", "page", "host", *digest, F.transform(split_lines(F.col("text")), line_key).alias("keys"))
    keyed = materialize(keyed)
    counted = materialize(keyed.select("host", "digest", "keys").dropDuplicates(["host", "digest"])) if copies_once else keyed
    bad = materialize(boilerplate_lines(counted, max_ratio, min_pages))
    n_lines = keyed.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]
    pairs = bad.select(F.xxhash64("host", "line_key").alias("pair"), F.col("host").alias("bad_host"), F.col("line_key").alias("bad_key"), "n_with")
    lines = keyed.select("row_key", "host", F.posexplode("keys").alias("pos", "line_key")).where(F.col("line_key").isNotNull())
    lines = lines.withColumn("pair", F.xxhash64("host", "line_key"))
    hot = pairs.where(F.col("n_with") > n_lines / HOT_PARTS)
    rest = pairs.where(F.col("n_with") <= n_lines / HOT_PARTS)
    same = (F.col("host") == F.col("bad_host")) & (F.col("line_key") == F.col("bad_key"))
    flagged = lines.join(F.broadcast(hot.select("pair", "bad_host", "bad_key")), "pair", "left").withColumn("is_hot", F.coalesce(same, F.lit(False)))
    of_hot = flagged.where("is_hot").select("row_key", "pos")
    of_rest = (
        flagged.where(~F.col("is_hot")).select("row_key", "pos", "pair", "host", "line_key")
        .join(rest.select("pair", "bad_host", "bad_key"), "pair").where(same).select("row_key", "pos")
    )
    drops = of_hot.unionByName(of_rest).groupBy("row_key").agg(F.collect_set("pos").alias("drop"))
    kept = F.filter(F.transform("lines", lambda x, i: F.struct(x.alias("line"), i.alias("pos"))), lambda s: ~F.array_contains(F.coalesce("drop", F.array().cast("array<int>")), s["pos"]))
    return (
        base.join(drops, "row_key", "left")
        .withColumn("lines", split_lines(F.col("text")))
        .select(
            "page",
            F.when(F.col("host") != "", F.col("host")).alias("host"),
            F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.concat_ws("\n", F.transform(kept, lambda s: s["line"]))).alias("text"),
            F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("lines")).cast("long").alias("n_lines"),
            F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
            *(["row"] if carry else []),
        )
    )

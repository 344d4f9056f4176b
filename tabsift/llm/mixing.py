"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import join_hot

#: Sweeps go on until no margin's share is off its target by more than this; factors are rounded to 6 decimals.
TOLERANCE = 1e-12
#: Targets that no scaling of the filled cells can meet never get there: the sweeps end once SLOW of them together gain
#: less than a tenth, with a warning.
SLOW = 8

NONE = "(none)"


def text_kind(text: Column) -> Column:
    """A coarse topic read off a text's form: ``table``, ``shout``, ``short``, ``long`` or ``prose``; null text: ``short``."""
    return (
        F.when(text.contains(" | "), "table")
        .when(text.contains("!!"), "shout")
        .when(F.coalesce(F.length(text), F.lit(0)) < 500, "short")
        .when(F.length(text) >= 5000, "long")
        .otherwise("prose")
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0B]+")), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and seed only (52 bits of an MD5)."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def tempered(cells: DataFrame, margin: str, temperature: float) -> DataFrame:
    """Target shares of a margin, proportional to its token mass to the power ``temperature``: ``margin, target``."""
    mass = cells.groupBy(margin).agg(F.sum("tokens").alias("mass")).where(F.col("mass") > 0)
    powered = mass.select(margin, F.pow("mass", F.lit(float(temperature))).alias("power"))
    whole = powered.agg(F.sum("power").alias("whole"))
    return powered.join(F.broadcast(whole)).select(margin, (F.col("power") / F.col("whole")).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` with ``factor``: after scaling tokens by it, every margin has its target shares (``margin, target``).

    Each step divides a margin value's target share by its present share and scales the value's cells by it.  Cells
    without tokens, or whose margin value has no target, get factor 0.  Sweeps over all margins end when the largest error of a
    margin's share, taken just before the margin is scaled, is at most ``tolerance``; if the errors stop falling first, the
    targets contradict each other, and the factors of the last sweep are returned with a warning.  Cells are far fewer than
    documents (one per filled combination) but no bound on them is needed: a sweep is a plan of its own, of sums with map-side
    partials and equi-joins, whose table is written to the shared folder; one number a sweep comes to the driver.
    """
    whole = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    fitted = cells.withColumn("factor", F.lit(1.0)).withColumn("gap", F.lit(0.0))
    for margin, target in targets.items():
        fitted = fitted.join(target.withColumnRenamed("target", f"target_{margin}"), margin, "left")
    fitted, gaps = materialize(fitted), []
    while True:
        fitted = fitted.withColumn("gap", F.lit(0.0))
        for margin in targets:
            mass, target = F.sum(F.col("tokens") * F.col("factor")), F.coalesce(F.max(f"target_{margin}"), F.lit(0.0))
            step = F.when(mass > 0, target * F.lit(whole) / mass)
            gap = F.abs(F.coalesce(mass, F.lit(0.0)) / F.lit(whole) - target)
            steps = fitted.groupBy(margin).agg(F.coalesce(step, F.lit(0.0)).alias("step"), gap.alias("off"))
            fitted = fitted.join(steps, margin)
            fitted = fitted.withColumn("factor", F.col("factor") * F.col("step")).withColumn("gap", F.greatest("gap", "off")).drop("step", "off")
        fitted = materialize(fitted)
        gaps.append(fitted.agg(F.coalesce(F.max("gap"), F.lit(0.0))).first()[0])
        if gaps[-1] <= tolerance:
            break
        if len(gaps) > SLOW and gaps[-1] > 0.9 * gaps[-1 - SLOW]:
            if gaps[-1] > 1e-9:
                warnings.warn(f"the targets contradict each other: after {len(gaps)} sweeps a margin's share is still off by {gaps[-1]:.2g}")
            break
    return fitted.drop("gap", *(f"target_{m}" for m in targets))


def _cell(names: list[str]) -> Column:
    """One key for a combination of margin values (lengths keep combinations apart)."""
    return F.concat_ws("|", *(F.concat(F.length(n).cast("string"), F.lit(":"), F.col(n)) for n in names))


def mix_sources(
    docs: DataFrame,
    margins: dict[str, Column],
    temperatures: dict[str, float],
    tokens: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: float = 1.0,
    seed: int = 42,
    targets: dict[str, DataFrame] | None = None,
    with_row: bool = False,
    copies: bool = False,
) -> DataFrame:
    """``doc_id``, the margins, ``n_tokens, factor, probability, kept, weight`` (and ``row``, a struct of the
    input's columns, if ``with_row``); one row per input row.

    ``factor`` is the raked ratio of target to present token mass of the document's cell.  A document is kept with
    probability ``min(1, keep * factor)``, decided by a hash of its id, so repeated ids share one decision.
    ``weight`` is ``keep * factor / probability``: kept tokens times it meet the margins in expectation.
    A null margin value is the category ``(none)``; a null text has no tokens; documents of a cell without
    tokens have factor 1 (they carry no mass, so they can't disturb a margin).  A missing target table is made from
    ``temperatures``.  An empty table gives no rows; clashing columns of the input stay inside ``row``.

    With ``copies`` the kept rows themselves meet the margins in expectation, without weights: factors are scaled by one
    number so that as many documents are expected as ``min(1, keep * factor)`` keeps, and a document comes as
    often as its scaled factor says, the fraction decided by a hash of its id and text; one not kept comes once.
    """
    names = list(margins)
    columns = [F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for n, c in margins.items()]
    counted = (tokens if tokens is not None else word_count(F.col(text_col))).cast("long").alias("n_tokens")
    view = docs.select(F.col(id_col).alias("doc_id"), *columns, counted, *([F.struct("*").alias("row")] if with_row else []))
    if not with_row:
        view = materialize(view)
    cells = materialize(view.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")))
    goals = {n: (targets or {}).get(n) or tempered(cells, n, temperatures[n]) for n in names}
    fitted = rake(cells, goals)
    total = cells.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    rounded = F.when(F.col("tokens") > 0, F.round("factor", 6)).otherwise(1.0)
    sized = fitted.select(_cell(names).alias("cell"), rounded.alias("factor"), "rows")
    share = F.lit(float(keep)) * F.col("factor")
    if copies:
        expected = sized.agg(F.sum(F.least(F.lit(1.0), share) * F.col("rows")) / F.sum(share * F.col("rows"))).first()[0]
        share = share * F.lit(float(expected or 0.0))
        view = view.withColumn("text_digest", F.md5((F.col(f"row.{text_col}") if with_row else F.lit("")).cast("binary")))
    done = join_hot(view.withColumn("cell", _cell(names)), sized, "cell", "rows", total)
    if copies:
        draw = uniform(F.concat_ws(":", F.col("doc_id").cast("string"), "text_digest"), seed)
        number = (F.floor(share) + (draw < share - F.floor(share)).cast("long")).cast("int")
        done = done.withColumn("number", number).withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("number")))))
        kept, weight = F.col("number") > 0, F.lit(1.0)
    else:
        kept = uniform(F.col("doc_id"), seed) < F.col("probability")
        weight = F.round(F.lit(float(keep)) * F.col("factor") / F.col("probability"), 9)
    return done.withColumn("probability", F.least(F.lit(1.0), share)).select(
        "doc_id",
        *names,
        "n_tokens",
        "factor",
        "probability",
        kept.alias("kept"),
        F.when(F.col("probability") > 0, weight).otherwise(0.0).alias("weight"),
        *(["row"] if with_row else []),
    )

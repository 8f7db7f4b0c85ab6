"""Mixing sources to target weights, in DataFrame functions only.

Method (iterative proportional fitting): documents are counted into cells of (source, language,
topic), a few rows pre-aggregated before the shuffle. The cells' token weights are raked to the
target share of each source, each language and each topic in turn until all marginals fit, or no sweep brings them nearer (the targets contradict
each other where cells are missing: the error left on each axis is logged as a warning). A
document's probability is its cell's weight times the token budget, over the cell's tokens, at most
1; what that cap takes away goes to the other cells. A document is sampled when a hash of its id is
below its probability, so the choice is the same at every run and on every executor.

Where no targets are given, they are the marginals raised to the power ``temper`` (and normalised),
which holds back a source that has a third of all tokens. Where there is no topic column, the topic is
the form of the text: mostly numbers, lines, or prose.

Edge cases: null or empty source, language and topic are ''; a null text has no tokens; cells
without tokens are kept whole (nothing to weigh); a category without a target keeps its share;
documents with one id are sampled or left together; an empty table gives no rows.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.workspace import written

logger = logging.getLogger(__name__)

AXES = ("source", "lang", "topic")
WORD = "[^\\x20\\x09-\\x0D]+"
PARTS = 1 << 53


def form(text: Column) -> Column:
    """The topic of a text where none is given."""
    size = F.length(text)
    digits = size - F.length(F.translate(text, "0123456789", ""))
    lines = size - F.length(F.translate(text, "\n", ""))
    return F.when(20 * digits > size, F.lit("numbers")).when(80 * lines > size, F.lit("lines")).otherwise(F.lit("prose"))


def weighed(docs: DataFrame, *carry: str, topic: str | None = None) -> DataFrame:
    """``doc`` (the carried columns), the axes and ``n_tokens`` (words) of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    axis = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("source", "lang")]
    last = F.coalesce(F.col(topic).cast("string"), F.lit("")) if topic else form(text)
    return docs.select(
        F.struct(*carry).alias("doc"),
        F.xxhash64(F.col("doc_id"), F.lit("mixing")).alias("draw"),
        *axis,
        last.alias("topic"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
    )


def target_shares(cells: DataFrame, axis: str, temper: float, given: DataFrame | None) -> DataFrame:
    """``axis, target``: shares of the categories that occur, which add up to 1."""
    totals = cells.groupBy(axis).agg(F.sum("tokens").cast("double").alias("have")).filter("have > 0")
    if given is None:
        raw = totals.withColumn("raw", F.pow("have", F.lit(temper)))
    else:
        share = F.col("have") / F.lit(cells.agg(F.sum("tokens")).first()[0] or 1)
        raw = totals.join(given.select(axis, F.col("share").cast("double").alias("share")), axis, "left").withColumn("raw", F.coalesce("share", share))
    return raw.select(axis, (F.col("raw") / F.lit(raw.agg(F.sum("raw")).first()[0] or 1.0)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-6, progress: float = 1e-3) -> DataFrame:
    """``cells`` with ``weight``: shares of tokens whose marginals are the targets.

    Each sweep rakes every axis and is written, which cuts the lineage; sweeps end when the largest
    relative error of a marginal, seen before its raking, is within ``tolerance``, or when it hasn't
    fallen by ``progress`` of itself for three sweeps. Targets that contradict each other end so: the
    axis raked last fits, and the error left on each axis is logged as a warning.
    """
    spark = cells.sparkSession
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    cells = cells.withColumn("weight", F.col("tokens") / F.lit(total))
    least, idle = float("inf"), 0
    while True:
        for axis, target in targets.items():
            sums = cells.groupBy(axis).agg(F.sum("weight").alias("sum")).filter("sum > 0")
            factors = sums.join(target, axis).select(axis, (F.col("target") / F.col("sum")).alias("factor"))
            cells = cells.join(factors, axis, "left").withColumn("factor", F.coalesce("factor", F.lit(1.0)))
            error = F.abs(F.col("factor") - 1)
            cells = cells.withColumns({"weight": F.col("weight") * F.col("factor"), f"error_{axis}": error}).drop("factor")
        cells = written(spark, cells, "raked-cells")
        errors = cells.agg(*[F.max(f"error_{a}").alias(a) for a in targets]).first().asDict()
        cells = cells.drop(*[f"error_{a}" for a in targets])
        worst = max((e for e in errors.values() if e is not None), default=0.0)
        if worst <= tolerance:
            return cells
        least, idle = (worst, 0) if worst < least * (1 - progress) else (least, idle + 1)
        if idle == 3:
            logger.warning("targets don't fit together; relative error left before the last sweep: %s", errors)
            return cells


def probabilities(cells: DataFrame, keep: float) -> DataFrame:
    """``cells`` with ``probability``, so that about ``keep`` of all tokens are sampled by weight.

    The scale that gives the budget, cells capped at all their tokens, is reached from below: each
    step spreads what is missing over the cells that aren't full; every step fills a cell or ends.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    scale, budget = keep * total, keep * total
    while budget:
        full = F.col("weight") * scale >= F.col("tokens")
        spent, free = cells.filter("tokens > 0").agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight")))).first()
        better = (budget - float(spent or 0)) / free if free else scale
        if better <= scale * (1 + 1e-9):
            break
        scale = better
    share = F.least(F.lit(1.0), F.col("weight") * F.lit(float(scale)) / F.col("tokens"))
    return cells.withColumn("probability", F.when(F.col("tokens") > 0, share).otherwise(F.lit(1.0)))


def calibrated(docs: DataFrame, keep: float = 0.5, temper: float = 0.7, targets: dict[str, DataFrame] | None = None, topic: str | None = None) -> DataFrame:
    """The cells with their raked weights and probabilities."""
    cells = weighed(docs, "doc_id", topic=topic).groupBy(*AXES).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))
    cells = written(docs.sparkSession, cells, "cells")
    shares = {a: written(docs.sparkSession, target_shares(cells, a, temper, (targets or {}).get(a)), "targets") for a in AXES}
    return written(docs.sparkSession, probabilities(rake(cells, shares), keep), "probabilities")


def mix(docs: DataFrame, *carry: str, topic: str | None = None, **rule) -> DataFrame:
    """Sampled documents: ``doc`` (the carried columns), axes, ``n_tokens``, ``weight`` and ``probability``."""
    cells = calibrated(docs, topic=topic, **rule).select(*AXES, "weight", "probability")
    drawn = F.pmod(F.col("draw"), F.lit(PARTS)) / F.lit(float(PARTS))
    return weighed(docs, *carry, topic=topic).join(cells, list(AXES)).filter(drawn < F.col("probability")).drop("draw")


def mixed_sample(docs: DataFrame, **rule) -> DataFrame:
    """One row per sampled document, without its text."""
    return mix(docs, "doc_id", **rule).select("doc.doc_id", *AXES, "n_tokens", "weight", "probability")

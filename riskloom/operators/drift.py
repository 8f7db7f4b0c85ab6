"""Drift of live data against a baseline: PSI, KL and Jensen-Shannon divergence.

Numeric columns fall into equal-width (or quantile) bins whose edges are frozen on the baseline;
categorical columns are their own bins. Rows are reduced to (group, column, bin) counts by one
pre-aggregated shuffle; everything after that works on those counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.quantiles import column_stats, exact_quantiles

BINS = 10
SHARE_FLOOR = 1e-4
METRICS = ["psi", "kl", "jsd"]
WHOLE = "__all__"
NULL_BIN = "__null__"


@dataclass(frozen=True)
class Edges:
    """Bin edges frozen on a baseline: (min, max) per column, or inner quantile cuts."""

    ranges: dict
    cuts: dict
    bins: int = BINS

    @property
    def numeric(self) -> list[str]:
        return [*self.ranges, *self.cuts]


def fit_edges(baseline: DataFrame, numeric: list[str], method: str = "width", bins: int = BINS) -> Edges:
    """Edges from the baseline; two numbers per column (or ``bins - 1`` cuts) reach the driver."""
    if not numeric:
        return Edges({}, {}, bins)
    if method == "quantile":
        found = exact_quantiles(baseline, numeric, [k / bins for k in range(1, bins)])
        return Edges({}, {c: sorted({v for v in cuts if v is not None}) for c, cuts in found.items()}, bins)
    if method != "width":
        raise ValueError("method must be 'width' or 'quantile'")
    finite = [F.when(F.abs(F.col(c).cast("double")) < math.inf, F.col(c).cast("double")).alias(c) for c in numeric]
    stats = column_stats(baseline.select(*finite), list(numeric))
    return Edges({c: (stats[c].lo, stats[c].hi) for c in numeric}, {}, bins)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def bin_of(name: str, edges: Edges) -> Column:
    """The bin of a numeric column, 0..bins-1; NULL and NaN have the bin -1 to themselves.

    Ranges are those of the finite values; an infinite value falls into the first or last bin.

    Written as SQL text: one parse per column instead of dozens of Column calls.
    """
    x, last = f"double({_quoted(name)})", edges.bins - 1
    if name in edges.cuts:
        place = " + ".join(["0", *[f"if({x} > double('{cut!r}'), 1, 0)" for cut in edges.cuts[name]]])
    else:
        lo, hi = edges.ranges[name]
        if lo is None:
            place = "0"
        elif lo == hi:
            place = f"if({x} > {lo!r}D, {last}, 0)"
        else:
            share = f"({x} - {lo!r}D) / {hi - lo!r}D * {float(edges.bins)!r}D"
            if math.isinf(hi - lo):  # wider than the largest double: work on halves
                share = f"({x} * 0.5D - {lo * 0.5!r}D) / {hi * 0.5 - lo * 0.5!r}D * {float(edges.bins)!r}D"
            place = f"int(floor(least({float(last)!r}D, greatest(0D, {share}))))"
    return F.expr(f"if({x} IS NULL OR isnan({x}), -1, {place})")


def time_bucket(ts: str, granularity: str) -> Column:
    """Start of the window a timestamp falls into."""
    if granularity == "day":
        return F.col(ts).cast("date").cast("timestamp_ntz")
    return F.date_trunc(granularity, F.col(ts)).cast("timestamp_ntz")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(NULL_BIN))


def fine_counts(
    df: DataFrame,
    edges: Edges,
    categorical: list[str] = (),
    segments: list[str] = (),
    by: dict[str, Column] | None = None,
) -> DataFrame:
    """(by..., segment_column, segment_value, column, bin, n): rows counted once.

    A row is stacked by (segment column, column) before it is counted, so the cost grows with the
    number of segment columns, not with the product of their values. A single grouping, so it also
    runs on a stream.
    """
    by, names = by or {}, [*edges.numeric, *categorical]
    held = [f"_s{i}" for i in range(len(segments))]
    binned = df.select(
        *[c.alias(n) for n, c in by.items()],
        *[_text(s).alias(h) for s, h in zip(segments, held)],
        *[bin_of(c, edges).alias(f"_n{i}") for i, c in enumerate(edges.numeric)],
        *[_text(c).alias(f"_t{i}") for i, c in enumerate(categorical)],
    )
    # stack, not an exploded array of structs: it emits rows without boxing them
    first_text = len(edges.numeric)
    cells = [f"{i}, _n{i}, string(NULL)" for i in range(first_text)]
    cells += [f"{first_text + i}, int(NULL), _t{i}" for i in range(len(categorical))]
    if segments:
        views = ["-1, string(NULL)", *[f"{i}, {h}" for i, h in enumerate(held)]]
        spread = [name for name in binned.columns if name not in held]
        binned = binned.selectExpr(*[_quoted(c) for c in spread], f"stack({len(views)}, {', '.join(views)}) AS (_k, _value)")
    else:
        binned = binned.selectExpr("*", "-1 AS _k", "string(NULL) AS _value")
    keyed = binned.selectExpr(*[_quoted(c) for c in by], "_k", "_value", f"stack({len(names)}, {', '.join(cells)}) AS (_c, _number, _text)")
    # column ids and int bins keep the grouping keys short; names come back on the counts
    counted = keyed.groupBy(*by, "_k", "_value", "_c", "_number", "_text").agg(F.count("*").alias("n"))
    return counted.select(
        *by,
        # never NULL: a join on them adds no filter below the counts, and their shuffle is used again
        F.coalesce(F.element_at(F.array(*[F.lit(n) for n in [WHOLE, *segments]]), F.col("_k") + 2), F.lit(WHOLE)).alias("segment_column"),
        F.coalesce("_value", F.lit(WHOLE)).alias("segment_value"),
        F.coalesce(F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_c") + 1), F.lit("")).alias("column"),
        F.coalesce(F.col("_number").cast("string"), F.col("_text"), F.lit(NULL_BIN)).alias("bin"),
        "n",
    )


def bin_counts(
    df: DataFrame,
    edges: Edges,
    categorical: list[str] = (),
    segments: list[str] = (),
    by: dict[str, Column] | None = None,
) -> DataFrame:
    """(by..., segment_column, segment_value, column, bin, n); ``by`` holds e.g. a time window."""
    return fine_counts(df, edges, categorical, segments, by)


def _terms(p: Column, q: Column) -> dict[str, Column]:
    """What one bin adds to each metric."""
    middle = p + q
    return {
        "psi": (p - q) * F.log(p / q),
        "kl": p * F.log(p / q),
        "jsd": 0.5 * p * F.log(2 * p / middle) + 0.5 * q * F.log(2 * q / middle),
    }


def drift_from_counts(baseline: DataFrame, live: DataFrame, by: list[str] = ()) -> DataFrame:
    """All three metrics per (by..., segment, column) from two ``bin_counts`` frames.

    ``by`` names group columns only the live side has. Bins missing on one side count as zero.
    The baseline's bins aren't copied into every window; their sum at the floor share is a constant
    of the (segment, column), and a live bin adds how it differs from that. Live bins meet those of the
    baseline by (segment, column, bin), and all sums combine before they are shuffled, so neither the
    windows nor the values of one column come together in a task.
    """
    shared = ["segment_column", "segment_value", "column"]

    def share(n: str, total: str) -> Column:
        ratio = F.try_divide(F.col(n).cast("double"), F.col(total).cast("double"))
        return F.greatest(F.lit(SHARE_FLOOR), F.coalesce(ratio, F.lit(0.0)))

    def with_total(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
        renamed = {k: f"_{k}" for k in keys}
        total = counts.groupBy(*keys).agg(F.sum("n").alias(name)).withColumnsRenamed(renamed)
        # a window or a segment may be NULL
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()])
        return counts.join(total, same).select(*counts.columns, name)

    cells = baseline.groupBy(*shared, "bin").agg(F.sum("n").alias("n"))
    base = with_total(cells, shared, "_total").select(*shared, "bin", share("n", "_total").alias("_q"))
    absent = _terms(F.lit(SHARE_FLOOR), F.col("_q"))
    constants = base.groupBy(*shared).agg(*[F.sum(c).alias(f"_{m}") for m, c in absent.items()])
    ours = with_total(live, [*by, *shared], "_whole").select(*by, *shared, "bin", share("n", "_whole").alias("_p"))
    met = ours.join(base, [*shared, "bin"], "left")
    present = _terms(F.col("_p"), F.coalesce("_q", F.lit(SHARE_FLOOR)))
    more = {m: c - F.when(F.col("_q").isNotNull(), absent[m]).otherwise(0.0) for m, c in present.items()}
    sums = met.groupBy(*by, *shared).agg(*[F.sum(c).alias(m) for m, c in more.items()])
    return sums.join(constants, shared, "left").select(
        *by, *shared, *[F.round(F.coalesce(F.col(f"_{m}"), F.lit(0.0)) + F.col(m), 6).alias(m) for m in METRICS]
    )


def drift(
    baseline: DataFrame,
    live: DataFrame,
    numeric: list[str] = (),
    categorical: list[str] = (),
    segments: list[str] = (),
    granularity: str | None = None,
    ts: str = "ts",
    edges: Edges | None = None,
) -> DataFrame:
    """Drift of every column, overall and per segment value, per time window if asked for."""
    edges = edges or fit_edges(baseline, list(numeric))
    window = {"window_start": time_bucket(ts, granularity)} if granularity else {}
    return drift_from_counts(
        bin_counts(baseline, edges, categorical, segments),
        bin_counts(live, edges, categorical, segments, by=window),
        by=list(window),
    )


def to_long(wide: DataFrame) -> DataFrame:
    """One row per metric instead of one column per metric."""
    keys = [c for c in wide.columns if c not in METRICS]
    return wide.unpivot(keys, METRICS, "metric", "metric_value")


def drift_report(baseline: DataFrame, live: DataFrame, numeric: list[str], categorical: list[str], **kw) -> DataFrame:
    """Long form: one row per group, column and metric."""
    return to_long(drift(baseline, live, numeric, categorical, **kw))

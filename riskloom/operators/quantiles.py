"""Exact quantiles of whole columns with bounded memory."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.workspace import written

HISTOGRAM_ROWS = 65_536
MOST_BINS = 4096
SMALLEST_EXPONENT = 1100  # log2 of any double lies above -1100 and below 1100


def _valid(name: str):
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _ranks(n: int, probability: float) -> tuple[int, int, float]:
    position = (n - 1) * probability
    low = math.floor(position)
    return low, math.ceil(position), position - low


@dataclass(frozen=True)
class ColumnStats:
    """What one scan tells about a column; NULL and NaN are left out."""

    n: int = 0
    lo: float | None = None
    hi: float | None = None
    mean: float | None = None
    variance: float | None = None


def column_stats(df: DataFrame, columns: list[str]) -> dict[str, ColumnStats]:
    """Count, range, mean and population variance of many columns in one scan.

    The columns are stacked to (column, value) and aggregated per column before the shuffle; an
    aggregate of several functions for each of many columns would be too large to compile.
    """
    if not columns:
        return {}
    values = df.select(*[_valid(c).alias(f"x{i}") for i, c in enumerate(columns)])
    cells = ", ".join(f"{i}, x{i}" for i in range(len(columns)))
    rows = (
        values.selectExpr(f"stack({len(columns)}, {cells}) AS (k, x)")
        .filter("x IS NOT NULL")
        .groupBy("k")
        .agg(F.count("*").alias("n"), F.min("x"), F.max("x"), F.avg("x"), F.var_pop("x"))
        .collect()
    )
    found = {columns[row["k"]]: ColumnStats(*row[1:]) for row in rows}
    return {c: found.get(c, ColumnStats()) for c in columns}


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], stats: dict[str, ColumnStats] | None = None
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles, NULL and NaN left out.

    A sort or a map of distinct values would put a whole column into one task. Instead every
    wanted rank is narrowed down: one pass counts the values of its interval into equal-width
    bins with their smallest and largest value, and the bin that holds the rank is the next
    interval. An interval whose ends differ by more than a factor of two is cut by the exponent, so
    one or two passes bring any interval, infinite ones too, down to doubles of about one size; of
    those there are 2^52, and a pass leaves one bin of them. That bounds the passes at seven for up
    to 16 intervals at a time. Every pass is one scan with a pre-aggregated grouping and returns
    at most HISTOGRAM_ROWS rows for all columns together. ``stats`` may hand in the result of an
    earlier first scan.
    """
    columns = list(dict.fromkeys(columns))
    values = df.select(*[_valid(c).alias(f"x{i}") for i, c in enumerate(columns)])
    stats = stats or column_stats(df, columns)
    bounds = [(stats[c].n, stats[c].lo, stats[c].hi) for c in columns]

    settled: dict[tuple[int, int], float] = {}
    open_ranks: dict[tuple[int, int], tuple[float, float, int]] = {}
    for i, (n, lo, hi) in enumerate(bounds):
        for p in probabilities if n else []:
            for rank in _ranks(n, p)[:2]:
                if lo == hi:
                    settled[i, rank] = lo
                else:
                    open_ranks[i, rank] = (lo, hi, 0)

    while open_ranks:
        intervals = sorted({(i, lo, hi) for (i, _), (lo, hi, _) in open_ranks.items()})
        bins = max(16, min(MOST_BINS, HISTOGRAM_ROWS // len(intervals)))
        histogram = _histogram(values, intervals, bins)
        still_open = {}
        for (i, rank), (lo, hi, below) in open_ranks.items():
            for n, smallest, largest in histogram[i, lo, hi]:
                if rank < below + n:
                    break
                below += n
            if smallest == largest or rank == below:
                settled[i, rank] = smallest
            elif rank == below + n - 1:
                settled[i, rank] = largest
            else:
                still_open[i, rank] = (smallest, largest, below)
        open_ranks = still_open

    result = {}
    for i, name in enumerate(columns):
        n = bounds[i][0]
        row = []
        for p in probabilities:
            if not n:
                row.append(None)
                continue
            low, high, part = _ranks(n, p)
            a, b = settled[i, low], settled[i, high]
            row.append(a if part == 0 or a == b else a + (b - a) * part)
        result[name] = row
    return result


def _double(x: float) -> str:
    """A SQL literal of any double."""
    return f"double('{x!r}')" if math.isinf(x) else f"{x!r}D"


def _one_size(lo: float, hi: float) -> bool:
    """Whether equal widths suit an interval: one sign, and ends within about a factor of two."""
    small, large = sorted((abs(lo), abs(hi)))
    return (lo > 0) == (hi > 0) and small > 0 and not math.isinf(large) and large <= 2.2 * small


def _exponent(x: float) -> float:
    """The signed exponent that orders doubles of any size; agrees with the SQL in order, not to the bit."""
    if x == 0:
        return 0.0
    size = SMALLEST_EXPONENT if math.isinf(x) else max(-SMALLEST_EXPONENT, min(SMALLEST_EXPONENT, math.log2(abs(x))))
    return math.copysign(size + SMALLEST_EXPONENT, x)


def grouped_quantile(df: DataFrame, groups: list[str], value: str, probability: float) -> DataFrame:
    """(groups..., quantile): the interpolated exact quantile of every group, of any number and size.

    Equal values are counted first; the counts are range-partitioned by (group, value) and
    written, so that a group of any size spans tasks. Running totals inside the ranges plus those of
    the ranges before give every value its ranks. NULL and NaN are left out.
    """
    spark = df.sparkSession
    counts = df.select(*groups, _valid(value).alias("_x")).filter("_x IS NOT NULL").groupBy(*groups, "_x").agg(F.count("*").alias("_n"))
    ranged = counts.repartitionByRange(*groups, "_x").withColumn("_range", F.spark_partition_id())
    ranged = written(spark, ranged, "quantile-ranges")
    so_far = Window.partitionBy("_range", *groups).orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range", *groups).agg(F.sum("_n").alias("_size"))
    carried = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    position = ((F.sum("_size") - 1) * F.lit(float(probability))).alias("_position")
    totals = sizes.groupBy(*groups).agg(position)

    def same(names: list[str], left: DataFrame, right: DataFrame) -> DataFrame:
        """A join in which NULL groups are groups too."""
        other = right.withColumnsRenamed({n: f"_{n}_" for n in names})
        on = [F.col(n).eqNullSafe(F.col(f"_{n}_")) for n in names]
        return left.join(other, on).drop(*[f"_{n}_" for n in names])

    ranked = ranged.withColumn("_upto", F.sum("_n").over(so_far))
    ranked = same(groups, same(["_range", *groups], ranked, carried), totals)
    last = F.col("_before") + F.col("_upto") - 1
    first = last - F.col("_n") + 1
    low, high = F.floor("_position"), F.ceil("_position")
    ends = ranked.groupBy(*groups).agg(
        F.max(F.when((first <= low) & (low <= last), F.col("_x"))).alias("_a"),
        F.max(F.when((first <= high) & (high <= last), F.col("_x"))).alias("_b"),
        F.first(F.col("_position") - F.floor("_position")).alias("_part"),
    )
    between = F.when((F.col("_part") == 0) | (F.col("_a") == F.col("_b")), F.col("_a"))
    return ends.select(*groups, between.otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")).alias("quantile"))


def _histogram(values: DataFrame, intervals: list[tuple[int, float, float]], bins: int) -> dict:
    """Per interval its filled bins, in order: rows, smallest and largest value.

    Values are stacked first and find their interval in arrays: an expression per interval would be too large to compile.
    """
    even = [_one_size(lo, hi) for _, lo, hi in intervals]
    ends = [(lo, hi) if same else (_exponent(lo), _exponent(hi)) for same, (_, lo, hi) in zip(even, intervals)]

    def of(numbers) -> str:
        return f"array({', '.join(map(_double, numbers))})[k]"

    size = f"greatest(-{SMALLEST_EXPONENT}D, least({SMALLEST_EXPONENT}D, log2(abs(x)))) + {SMALLEST_EXPONENT}D"
    signed = f"if(x = 0D, 0D, signum(x) * ({size}))"
    place = f"if(array({', '.join(str(e).lower() for e in even)})[k], x, {signed})"
    share = f"({place} - {of(a for a, _ in ends)}) / {of(b - a for a, b in ends)}"
    counted = (
        values.selectExpr(f"stack({len(intervals)}, {', '.join(f'{k}, x{i}' for k, (i, _, _) in enumerate(intervals))}) AS (k, x)")
        .filter(f"x >= {of(lo for _, lo, _ in intervals)} AND x <= {of(hi for _, _, hi in intervals)}")
        .selectExpr("k", f"int(least({bins - 1}, greatest(0, floor({share} * {bins})))) AS b", "x")
        .groupBy("k", "b")
        .agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        .collect()
    )
    out: dict = {interval: [] for interval in intervals}
    for row in sorted(counted, key=lambda r: (r["k"], r["b"])):
        out[intervals[row["k"]]].append((row["n"], row["lo"], row["hi"]))
    return out

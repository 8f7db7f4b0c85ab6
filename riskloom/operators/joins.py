"""Point-in-time retrieval and the other joins."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.workspace import written

HOT_KEY_ROWS = 2_000_000


@dataclass
class FeatureView:
    """A feature frame with its event time.

    ``tie_break`` orders rows of one key that share an event time; the greatest wins. The values
    themselves follow it, so the order is total and the answer never depends on partitioning.
    """

    frame: DataFrame
    ts: str
    values: list[str]
    tie_break: list[str] = field(default_factory=list)
    prefix: str = ""

    def output(self, name: str) -> str:
        return f"{self.prefix}{name}"

    @property
    def order(self) -> list[str]:
        kinds = dict(self.frame.dtypes)
        rest = [c for c in self.values if c not in self.tie_break and "map<" not in kinds.get(c, "map<")]
        return [*self.tie_break, *rest]


def _all_set(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _typed_nulls(view: FeatureView) -> tuple[str, str]:
    """SQL types of a view's value struct and of its tie-break struct."""
    ties = view.frame.select(*[F.col(c).alias(f"b{i}") for i, c in enumerate(view.order)])
    values = view.frame.select(*view.values)
    return values.schema.simpleString(), ties.schema.simpleString()


def _timeline(spine: DataFrame | None, views: list[FeatureView], keys: list[str], ts: str) -> DataFrame:
    """Spine and feature rows in one frame: keys, _t, _side, _spine and per view _v<i>, _b<i>."""
    kinds = [_typed_nulls(v) for v in views]

    def padded(owner: int | None) -> list[Column]:
        out = []
        for i, (view, (value_type, tie_type)) in enumerate(zip(views, kinds)):
            if i == owner:
                out.append(F.struct(*view.values).alias(f"_v{i}"))
                ties = [F.col(c).alias(f"b{j}") for j, c in enumerate(view.order)]
                out.append((F.struct(*ties) if ties else F.lit(0)).alias(f"_b{i}"))
            else:
                out.append(F.lit(None).cast(value_type).alias(f"_v{i}"))
                out.append(F.lit(None).cast(tie_type if view.order else "int").alias(f"_b{i}"))
        return out

    spine_type = None if spine is None else spine.schema.simpleString()
    frames = []
    if spine is not None:
        frames.append(
            spine.select(
                *keys,
                F.col(ts).alias("_t"),
                F.lit(1).alias("_side"),
                F.struct(*spine.columns).alias("_spine"),
                *padded(None),
            )
        )
    for i, view in enumerate(views):
        row = view.frame.filter(_all_set([*keys, view.ts]))
        spine_pad = [] if spine is None else [F.lit(None).cast(spine_type).alias("_spine")]
        frames.append(
            row.select(*keys, F.col(view.ts).alias("_t"), F.lit(0).alias("_side"), *spine_pad, *padded(i))
        )
    return reduce(DataFrame.unionByName, frames)


def _as_of_by_window(spine, views, keys, ts) -> DataFrame:
    """One shuffle on the entity keys for any number of views: the last feature row seen so far."""
    order = [F.col("_t"), F.col("_side"), *[F.col(f"_b{i}") for i in range(len(views))]]
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    looked_up = _timeline(spine, views, keys, ts).select(
        "_side", "_spine", *[F.last(f"_v{i}", ignorenulls=True).over(so_far).alias(f"_v{i}") for i in range(len(views))]
    )
    return looked_up.filter("_side = 1").select("_spine.*", *_outputs(views))


def _outputs(views: list[FeatureView]) -> list[Column]:
    return [
        F.col(f"_v{i}").getField(name).alias(view.output(name))
        for i, view in enumerate(views)
        for name in view.values
    ]


def hot_keys(frames: list[DataFrame], keys: list[str], at_least: int) -> DataFrame:
    """(keys..., _n) of all keys that hold more than ``at_least`` rows over all frames.

    A table in the shared folder: whether it is broadcast is left to Spark, which knows its size.
    """
    counted = reduce(DataFrame.unionByName, [f.select(*keys) for f in frames])
    counted = counted.filter(_all_set(keys)).groupBy(*keys).agg(F.count("*").alias("_n"))
    return written(counted.sparkSession, counted.filter(F.col("_n") > at_least), "hot-keys")


def _as_of_by_ranges(spine, views, keys, ts, n_rows: int, rows_per_range: int) -> DataFrame:
    """The as-of join for keys too large for one task.

    Copies of a (key, time) pair are combined first. The remaining rows are range-partitioned on
    (key, time), so a large key spans many ranges; each range looks back within itself, and
    the last feature row of the ranges before it is carried in. The carry frame has one row
    per (range, key), at most ranges + hot keys. The ranged rows are written out once: both uses
    of a range number must see the same numbering, also after an executor is lost. There are as
    many ranges as keep each at about ``rows_per_range``.
    """
    spans = range(len(views))
    marks = _timeline(spine.select(*keys, ts).distinct(), views, keys, ts)
    merged = marks.groupBy(*keys, "_t").agg(
        F.max("_side").alias("_asked"), *[F.max_by(f"_v{i}", f"_b{i}").alias(f"_v{i}") for i in spans]
    )
    ranges = max(2, -(-n_rows // rows_per_range))
    ranged = merged.repartitionByRange(ranges, *keys, "_t").withColumn("_range", F.spark_partition_id())
    ranged = written(spine.sparkSession, ranged, "as-of-ranges")

    within = Window.partitionBy("_range", *keys).orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy("_range", *keys)
        .agg(*[F.max_by(f"_v{i}", F.when(F.col(f"_v{i}").isNotNull(), F.col("_t"))).alias(f"_v{i}") for i in spans])
        .select("_range", *keys, *[F.last(f"_v{i}", ignorenulls=True).over(before).alias(f"_c{i}") for i in spans])
    )
    answered = (
        ranged.select(
            "_range", *keys, "_t", "_asked", *[F.last(f"_v{i}", ignorenulls=True).over(within).alias(f"_v{i}") for i in spans]
        )
        .filter("_asked = 1")
        .join(carried, ["_range", *keys], "left")
        .select(*keys, F.col("_t").alias(ts), *[F.coalesce(f"_v{i}", f"_c{i}").alias(f"_v{i}") for i in spans])
    )
    return spine.join(answered, [*keys, ts], "left").select(*spine.columns, *_outputs(views))


def retrieve_features(
    spine: DataFrame,
    views: list[FeatureView],
    keys: list[str],
    spine_ts: str,
    hot_rows: int | None = HOT_KEY_ROWS,
    rows_per_range: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Point-in-time join: beside each spine row, the newest row of every view not after it.

    Left-outer: spine rows without an earlier feature row, or without key or time, get NULLs.
    A count per key finds the keys with more than ``hot_rows`` rows, however many; those take the
    range path, all others share one shuffle. Both give the same rows. ``hot_rows=None`` skips the
    count.
    """
    names = [*spine.columns, *[v.output(c) for v in views for c in v.values]]
    twice = sorted({n for n in names if [x.lower() for x in names].count(n.lower()) > 1})
    if twice:
        raise ValueError(f"columns {twice} occur twice in the result: give the views prefixes")
    for view in views:
        kinds = dict(view.frame.dtypes)
        if not view.tie_break and any("map<" in kinds[c] for c in view.values):
            # rows of one time that differ in a map only would have no order
            raise ValueError("values that are maps have no order: give the view a tie_break")
    usable = spine.filter(_all_set([*keys, spine_ts]))
    unusable = spine.filter(~_all_set([*keys, spine_ts]))
    hot = None if hot_rows is None else hot_keys([usable, *[v.frame for v in views]], keys, hot_rows)
    n_rows = hot and hot.agg(F.sum("_n")).first()[0]
    if n_rows:
        names = hot.drop("_n")

        def part(frame: DataFrame, how: str) -> DataFrame:
            return frame.join(names, keys, how)

        def parts(how: str) -> list[FeatureView]:
            return [FeatureView(part(v.frame, how), v.ts, v.values, v.tie_break, v.prefix) for v in views]

        found = _as_of_by_window(part(usable, "left_anti"), parts("left_anti"), keys, spine_ts).unionByName(
            _as_of_by_ranges(
                part(usable, "left_semi"), parts("left_semi"), keys, spine_ts, n_rows, rows_per_range
            )
        )
    else:
        found = _as_of_by_window(usable, views, keys, spine_ts)
    types = dict(found.dtypes)
    empty = [F.lit(None).cast(types[v.output(n)]).alias(v.output(n)) for v in views for n in v.values]
    return found.unionByName(unusable.select("*", *empty))


def as_of_join(
    spine: DataFrame,
    features: DataFrame,
    keys: list[str],
    spine_ts: str,
    feature_ts: str,
    values: list[str],
    tie_break: list[str] = (),
    prefix: str = "",
    **limits,
) -> DataFrame:
    """``retrieve_features`` over a single feature frame."""
    view = FeatureView(features, feature_ts, list(values), list(tie_break), prefix)
    return retrieve_features(spine, [view], keys, spine_ts, **limits)


def predictions_to_labels(predicted: DataFrame, labels: DataFrame, id_cols: list[str]) -> DataFrame:
    """Put predictions beside labels by id."""
    return predicted.join(labels, id_cols, "inner")


def new_only(current: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``current`` whose key has not been seen."""
    return current.join(seen.select(*keys).distinct(), keys, "left_anti")

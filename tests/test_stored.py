"""Stored tables: keyed buckets with commits, views in buckets of time, datasets that grow."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from riskloom.operators.joins import as_of_join
from riskloom.operators.selection import latest_per_key
from riskloom.sources.buckets import BucketTable
from riskloom.sources.datasets import FeatureStore
from riskloom.sources.layout import TimeLayout
from riskloom.sources.paths import child_names, create_text, read_text
from riskloom.workspace import fresh_path

ROW = "k string, t int, v string"


def table(spark, **limits):
    return BucketTable(spark, fresh_path(spark, "buckets"), ["k"], ["t", "v"], **{"buckets": 4, "max_deltas": 2, "keep": 3} | limits)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_newest_row_per_key_over_many_merges(spark):
    kept, rng, everything = table(spark), random.Random(1), []
    assert kept.read() is None
    for step in range(7):
        batch = [(f"k{rng.randrange(9)}", rng.randrange(100), f"v{step}") for _ in range(6)]
        everything += batch
        frame = spark.createDataFrame(batch, ROW)
        assert kept.merge(frame, "w", step) == step
        assert kept.merge(frame, "w", step) == step  # repeated: nothing changes
        assert rows(kept.read()) == rows(latest_per_key(spark.createDataFrame(everything, ROW), ["k"], ["t", "v"]))
    assert max(len(f) for f in kept.manifest()["files"].values()) <= 3
    asked = spark.createDataFrame([("k1",), ("k2",), ("none",)], "k string")
    assert rows(kept.get(asked)) == [r for r in rows(kept.read()) if r[0] in ("k1", "k2")]
    assert kept.commits() == [4, 5, 6]
    used = {f for n in kept.commits() for fs in kept.manifest(n)["files"].values() for f in fs}
    assert set(child_names(spark, f"{kept.path}/data")) == used


def test_untouched_buckets_keep_their_files(spark):
    kept = table(spark, max_deltas=0)
    kept.merge(spark.createDataFrame([(f"k{i}", 0, "a") for i in range(30)], ROW))
    before = kept.manifest()["files"]
    kept.merge(spark.createDataFrame([("k1", 1, "b")], ROW))
    after = kept.manifest()["files"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert ("k1", 1, "b") in rows(kept.read()) and kept.read().count() == 30


def test_late_rows_refused_keys_and_other_columns(spark):
    kept = table(spark)
    kept.merge(spark.createDataFrame([("a", 5, "x")], ROW))
    kept.merge(spark.createDataFrame([("a", 4, "late"), ("b", 1, "y")], ROW))
    assert rows(kept.read()) == [("a", 5, "x"), ("b", 1, "y")]
    with pytest.raises(ValueError, match="full key"):
        kept.merge(spark.createDataFrame([(None, 5, "x")], ROW))
    with pytest.raises(ValueError, match="the table holds"):
        kept.merge(spark.createDataFrame([("a", 5)], "k string, t int"))
    kept.merge(spark.createDataFrame([], ROW))
    assert kept.read().count() == 2


def test_two_writers(spark):
    """Of two writers of one number the second goes on from the first one's state: no row is lost."""
    kept = table(spark, keep=100)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: kept.merge(spark.createDataFrame([(f"k{i}", i, "v"), ("all", i, "v")], ROW)), range(8)))
    assert kept.read().count() == 9 and ("all", 7, "v") in rows(kept.read())
    assert kept.commits() == list(range(8))


def test_commit_is_not_overwritten(spark):
    path = fresh_path(spark, "text")
    assert create_text(spark, path, "first") and not create_text(spark, path, "second")
    assert read_text(spark, path) == "first"


def test_online_table_of_a_stream(spark):
    """Refreshes merge into it, a restart goes on, compaction leaves nothing out."""
    store, source = FeatureStore(spark, fresh_path(spark, "store")), fresh_path(spark, "source")
    store.create_entity("p", ["k"])
    first = spark.createDataFrame([("a", 1, "x"), ("b", 9, "x")], ROW)
    store.create_view("f", first, "p", ts_column="t")
    store.maintain_online("f")
    for step in range(4):
        spark.createDataFrame([("a", 2 + step, f"y{step}"), ("b", step, "late"), (f"n{step}", 0, "new")], ROW).coalesce(1).write.mode("append").parquet(source)
        store.refresh_view("f", "v1", spark.readStream.schema(ROW).parquet(source), refresh=None).awaitTermination()
        want = rows(latest_per_key(store.read_view("f"), ["k"], ["t"]))
        assert rows(store.online_features("f")) == want
    before = rows(store.read_view("f"))
    assert store.compact_view("f") == 3 and store.compact_view("f") == 0
    assert rows(store.read_view("f")) == before and rows(store.online_features("f")) == want
    spark.createDataFrame([("a", 99, "z")], ROW).coalesce(1).write.mode("append").parquet(source)
    store.refresh_view("f", "v1", spark.readStream.schema(ROW).parquet(source), refresh=None).awaitTermination()
    assert ("a", 99, "z") in rows(store.online_features("f"))
    # the plan reads the maintained table, not the view
    plan = store.online_features("f")._jdf.queryExecution().executedPlan().toString()
    assert "/online/" in plan and "/views/" not in plan


SPINE = "k string, at timestamp_ntz, n int"
VIEW = "k string, t timestamp_ntz, tie int, v double, w string"


def times(spark, n, seed, view):
    """One key with half of the rows, ties, nulls, times on the borders of slices and before 1970."""
    rng, out = random.Random(seed), []
    for i in range(n):
        k = rng.choice(["hot"] * 6 + list("abcdef") + [None])
        day = rng.choice([rng.randrange(-900, 2000), 10 * rng.randrange(50), None if i % 40 == 0 else 0])
        out.append((k, None if day is None else day, i))
    frame = spark.createDataFrame(out, "k string, day int, i int")
    at = F.timestamp_add("DAY", F.col("day"), F.lit("1970-01-01").cast("timestamp_ntz")).cast("timestamp_ntz")
    if not view:
        return frame.select("k", at.alias("at"), F.col("i").alias("n"))
    return frame.select("k", at.alias("t"), (F.col("i") % 5).alias("tie"), F.when(F.col("i") % 7 > 0, F.col("i") * 1.0).alias("v"), F.col("i").cast("string").alias("w"))


@pytest.mark.parametrize("days", [10, 365, 100_000])
def test_layout_gives_the_as_of_join(spark, days):
    spine, view = times(spark, 300, 1, False), times(spark, 600, 2, True)
    layout = TimeLayout(spark, fresh_path(spark, "layout"), "v", ["k"], "t", ["v", "w"], ["tie"], seconds=days * 86400, buckets=5)
    layout.append(view.filter("int(w) % 3 = 0"))
    layout.append(view.filter("int(w) % 3 <> 0"))
    want = as_of_join(spine, view, ["k"], "at", "t", ["v", "w"], tie_break=["tie"])
    got = layout.retrieve(spine, "at")
    assert got.columns == want.columns and got.count() == 300
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert layout.retrieve(spine.limit(0), "at").isEmpty()
    with pytest.raises(ValueError, match="twice"):
        layout.retrieve(spine.withColumn("v", F.lit(1)), "at")


def above(plan: str, scan: str) -> list[str]:
    """The operators above the first scan of a plan whose line holds ``scan``."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and scan in line)
    depth, out = len(lines[at]) - len(lines[at].lstrip(" :+-")), []
    for line in reversed(lines[:at]):
        here = len(line) - len(line.lstrip(" :+-"))
        if here < depth and line.strip():
            depth = here
            out.append(line)
    return out


def test_layout_is_not_shuffled(spark):
    layout = TimeLayout(spark, fresh_path(spark, "layout"), "v", ["k"], "t", ["v", "w"], ["tie"], buckets=5)
    layout.append(times(spark, 600, 2, True))
    plan = layout.retrieve(times(spark, 300, 1, False), "at")._jdf.queryExecution().executedPlan().toString()
    way = above(plan, "/rows")
    assert any("Window" in line for line in way) and not any("Exchange" in line for line in way)
    assert "_slice" in plan[plan.index("PushedFilters") :]


def test_layout_is_found_again(spark):
    """By a session whose catalog doesn't know it."""
    root = fresh_path(spark, "layout")
    args = ("v", ["k"], "t", ["v", "w"], ["tie"])
    layout = TimeLayout(spark, root, *args, buckets=5)
    layout.append(times(spark, 100, 2, True))
    spine = times(spark, 50, 1, False)
    want = layout.retrieve(spine, "at")
    before = sorted(map(repr, want.collect()))
    for part in ("rows", "newest"):
        spark.sql(f"DROP TABLE `{layout._table(part)}`")
    assert sorted(map(repr, TimeLayout(spark, root, *args, buckets=5).retrieve(spine, "at").collect())) == before


def test_dataset_grows(spark):
    store, view = FeatureStore(spark, fresh_path(spark, "store")), times(spark, 400, 2, True)
    store.create_entity("p", ["k"])
    store.create_view("f", view, "p", ts_column="t", tie_break=["tie"])
    layout = store.layout("f", seconds=86400 * 90, buckets=3)
    spine = times(spark, 200, 1, False).dropna(subset=["at"])
    for i, until in enumerate(("1969-01-01", "1972-01-01", "2000-01-01")):
        part = spine.filter(F.col("at") < F.lit(until).cast("timestamp_ntz"))
        got = store.extend_dataset(part, {"f_": layout}, "at", "d", f"v{i}")
        want = store.layout("f", seconds=86400 * 90, buckets=3).retrieve(part, "at", "f_")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    own = spark.read.parquet(f"{store.root}/datasets/d/version=v2").count()
    assert 0 < own < got.count() == spine.count()


def test_performance_with_late_labels(spark):
    """Labels before, with and long after their predictions; some never; a restart in between."""
    from riskloom.streaming import performance as P
    from riskloom.streaming.live import drain, start

    folder = fresh_path(spark, "late")
    scored_schema, label_schema = "id int, ts timestamp_ntz, predicted string", "id int, y string, label_ts timestamp_ntz"

    def day(d):
        return f"2024-01-{d:02d} 12:00:00"

    def arrive(name, rows, schema):
        cast = [F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")]
        spark.createDataFrame(rows, ", ".join(f"{c.split()[0]} string" for c in schema.split(", "))).select(*cast).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")

    def run():
        scored = spark.readStream.schema(scored_schema).parquet(f"{folder}/scored")
        labels = spark.readStream.schema(label_schema).parquet(f"{folder}/labels")
        joined = P.labelled(scored, labels, ["id"], "y", wait="3 days")
        drain(start(P.performance_sink(joined, f"{folder}/out", "y", "predicted"), f"{folder}/checkpoint", None))

    arrive("scored", [("1", day(1), "a"), ("2", day(1), "b"), ("3", day(1), "a"), ("4", day(2), "a"), (None, day(2), "a")], scored_schema)
    arrive("labels", [("1", "a", day(1)), ("9", "b", day(1)), ("4", None, day(2))], label_schema)
    run()
    arrive("labels", [("2", "a", day(3)), ("3", "a", day(9))], label_schema)  # the second one comes too late
    arrive("scored", [("5", day(3), "b")], scored_schema)
    run()
    for d in (20, 25):  # both watermarks go on
        arrive("scored", [(f"{d}", day(d), "a")], scored_schema)
        arrive("labels", [(f"{d}", "a", day(d))], label_schema)
        run()
    run()
    got = {str(r.window_start)[8:10]: (r.accuracy, r.test_size, r.n_unlabelled) for r in P.live_performance(spark, f"{folder}/out").collect()}
    assert got == {"01": (0.5, 2, 1), "02": (None, None, 2), "03": (None, None, 1), "20": (1.0, 1, 0), "25": (1.0, 1, 0)}

"""Point-in-time joins against brute force, with the large-key path forced."""

import random
from datetime import datetime, timedelta

import pytest

from riskloom.operators.joins import FeatureView, as_of_join, hot_keys, new_only, retrieve_features
from riskloom.operators.selection import latest_per_key, prune_candidates

START = datetime(2024, 1, 1)


def make_rows(seed, n_features=400, n_spine=300):
    """Key 'a' holds most rows, many of them copies of one (key, time) pair."""
    rng = random.Random(seed)

    def key():
        return rng.choices(["a", "b", "c", "d", None], [70, 10, 10, 5, 5])[0]

    def time():
        return START + timedelta(hours=12 if rng.random() < 0.3 else rng.randrange(400))

    features = [(key(), time(), i, float(i) if i % 7 else None) for i in range(n_features)]
    spine = [(key(), None if rng.random() < 0.03 else time() - timedelta(hours=40), i % 50) for i in range(n_spine)]
    return features, spine


def brute_force(features, spine):
    out = []
    for key, at, tag in spine:
        seen = [(t, i, v) for k, t, i, v in features if key is not None and at is not None and k == key and t <= at]
        best = max(seen, key=lambda r: r[:2]) if seen else (None, None, None)
        out.append((key, at, tag, best[1], best[2]))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot_rows, rows_per_range", [(None, 1), (10_000, 1), (50, 37), (0, 20), (200, 5)])
@pytest.mark.parametrize("seed", [1, 2])
def test_as_of_join(spark, seed, hot_rows, rows_per_range):
    features, spine = make_rows(seed)
    left = spark.createDataFrame(spine, "k string, at timestamp_ntz, tag int")
    right = spark.createDataFrame(features, "k string, t timestamp_ntz, i int, v double")
    got = as_of_join(
        left, right, ["k"], "at", "t", ["i", "v"], tie_break=["i"], hot_rows=hot_rows, rows_per_range=rows_per_range
    )
    assert got.columns == ["k", "at", "tag", "i", "v"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_force(features, spine)


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_two_views_equal_two_joins(spark, hot_rows):
    features, spine = make_rows(3)
    more, _ = make_rows(4)
    left = spark.createDataFrame(spine, "k string, at timestamp_ntz, tag int")
    one = spark.createDataFrame(features, "k string, t timestamp_ntz, i int, v double")
    two = spark.createDataFrame(more, "k string, u timestamp_ntz, i int, v double")
    got = retrieve_features(
        left,
        [FeatureView(one, "t", ["i"], ["i"]), FeatureView(two, "u", ["i", "v"], ["i"], prefix="x_")],
        ["k"],
        "at",
        hot_rows=hot_rows,
        rows_per_range=25,
    )
    first = [(r[0], r[1], r[2], r[3]) for r in brute_force(features, spine)]
    second = [(r[0], r[1], r[2], r[3], r[4]) for r in brute_force(more, spine)]
    rows = [tuple(r) for r in got.select("k", "at", "tag", "i", "x_i", "x_v").collect()]
    assert sorted([r[:4] for r in rows], key=str) == sorted(first, key=str)
    assert sorted([(*r[:3], *r[4:]) for r in rows], key=str) == sorted(second, key=str)


def test_never_looks_ahead(spark):
    features, spine = make_rows(5)
    left = spark.createDataFrame(spine, "k string, at timestamp_ntz, tag int")
    right = spark.createDataFrame([(k, t, t, i) for k, t, i, _ in features], "k string, t timestamp_ntz, seen timestamp_ntz, i int")
    got = as_of_join(left, right, ["k"], "at", "t", ["seen"], tie_break=["i"], hot_rows=20, rows_per_range=10)
    assert got.filter("seen > at").count() == 0
    assert got.count() == len(spine)


def test_hot_keys(spark):
    frame = spark.createDataFrame([(k,) for k in "aaaabbbc"], "k string")
    assert sorted((r["k"], r["_n"]) for r in hot_keys([frame], ["k"], 1).collect()) == [("a", 4), ("b", 3)]


def test_many_hot_keys_and_ties(spark):
    """More hot keys than any list would hold, and ties without a tie-break: both paths agree."""
    spine = spark.range(1800).selectExpr("id % 600 AS k", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, id % 3) AS at")
    rows = spark.range(3600).selectExpr(
        "id % 600 AS k", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, id % 2) AS t", "id * 7919 % 1000 AS v", "string(id % 13) AS w"
    )
    got = [
        sorted(tuple(r) for r in as_of_join(spine, rows, ["k"], "at", "t", ["v", "w"], hot_rows=n, rows_per_range=500).collect())
        for n in (None, 3)
    ]
    assert got[0] == got[1] and len(got[0]) == 1800


def test_name_collisions_are_an_error(spark):
    frame = spark.sql("SELECT 'a' AS k, timestamp_ntz'2024-01-01' AS t, 1 AS v")
    with pytest.raises(ValueError, match="prefix"):
        as_of_join(frame.select("k", "t", "v"), frame.withColumnRenamed("t", "u"), ["k"], "t", "u", ["v"])


def test_latest_and_prune_against_sorting(spark):
    rng = random.Random(9)
    rows = [(rng.choice("aaaaaab"), rng.randrange(30), i) for i in range(200)]
    frame = spark.createDataFrame(rows, "g string, o int, i int")
    expected_latest, expected_pruned = [], []
    for g in "ab":
        mine = sorted([r for r in rows if r[0] == g], key=lambda r: r[1:], reverse=True)
        expected_latest.append(mine[0])
        expected_pruned += mine[3:]
    assert sorted(tuple(r) for r in latest_per_key(frame, ["g"], ["o", "i"]).collect()) == sorted(expected_latest)
    assert sorted(tuple(r) for r in prune_candidates(frame, ["g"], ["o", "i"], 3).collect()) == sorted(expected_pruned)


def test_new_only(spark):
    current = spark.createDataFrame([("x",), ("y",)], "alert string")
    seen = spark.createDataFrame([("x",), ("x",)], "alert string")
    assert [r[0] for r in new_only(current, seen, ["alert"]).collect()] == ["y"]


def test_map_values_need_a_tie_break(spark):
    spine = spark.sql("SELECT 'a' AS k, 5 AS at")
    view = spark.sql("SELECT 'a' AS k, 1 AS t, map('x', 1) AS m, 7 AS tie")
    with pytest.raises(ValueError, match="tie_break"):
        as_of_join(spine, view, ["k"], "at", "t", ["m"])
    assert as_of_join(spine, view, ["k"], "at", "t", ["m"], tie_break=["tie"]).head().m == {"x": 1}

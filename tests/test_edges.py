"""Values and shapes that used to fail or get lost."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift as R
from riskloom.operators import metrics as M
from riskloom.operators import preprocess as P
from riskloom.operators import quantiles as Q
from riskloom.operators.search import halving_promote
from riskloom.sources import tables as S
from riskloom.sources.datasets import FeatureStore
from riskloom.workspace import fresh_path


def _passes(monkeypatch):
    calls, own = [], Q._histogram

    def counted(*a):
        calls.append(1)
        return own(*a)

    monkeypatch.setattr(Q, "_histogram", counted)
    return calls


@pytest.mark.parametrize(
    "expr",
    [
        "power(10D, rand(1) * 600 - 300) * if(rand(2) < 0.3, -1, 1)",  # 600 orders of magnitude, both signs
        "if(id % 1000 = 0, exp(rand(3) * 700), rand(4))",
        "if(id % 3 = 0, 0D, 1e-300 * id)",
        "1D + id * 2.220446049250313e-16",
    ],
)
def test_heavy_tails_settle_in_seven_passes(spark, monkeypatch, expr):
    calls = _passes(monkeypatch)
    frame = spark.range(3000).selectExpr(f"double({expr}) AS x").persist()
    values = sorted(r.x for r in frame.collect())
    got = Q.exact_quantiles(frame, ["x"], [0.1, 0.5, 0.9])["x"]
    want = []
    for p in (0.1, 0.5, 0.9):
        low, high, part = Q._ranks(len(values), p)
        want.append(values[low] + (values[high] - values[low]) * part)
    assert got == pytest.approx(want, rel=1e-12) and len(calls) <= 7
    frame.unpersist()


def test_infinity(spark):
    frame = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, math.inf, -math.inf, math.inf, None)], "x double")
    assert Q.exact_quantiles(frame, ["x"], [0.0, 0.5, 1.0])["x"] == [-math.inf, 2.5, math.inf]
    report = {r.column: r.psi for r in R.drift(frame, frame, ["x"]).collect()}
    assert report == {"x": 0.0}
    wide = spark.createDataFrame([(x,) for x in (-1.7e308, 0.0, 1.7e308)], "x double")
    assert R.drift(wide, wide.filter("x > 0"), ["x"]).head()["psi"] > 1
    assert Q.exact_quantiles(wide, ["x"], [0.5])["x"] == [0.0]


def test_columns_without_values_and_empty_lists(spark):
    frame = spark.createDataFrame([(1.0, None, "a"), (3.0, None, "b")], "x double, y double, c string")
    scaled = P.standard_scale(frame, ["x", "y"]).collect()
    assert [r.x for r in scaled] == [-1.0, 1.0] and all(r.y is None for r in scaled)
    assert len(P.fit_preprocessor(frame, ["x"], []).transform(frame).head().features) == 1
    assert len(P.fit_preprocessor(frame, [], ["c"]).transform(frame).head().features) == 2
    with pytest.raises(ValueError):
        P.fit_preprocessor(frame, [], [])
    with pytest.raises(ValueError, match="too many"):
        P.fit_preprocessor(frame, [], ["c"], limit=1)
    weighted = P.weight_by_class(frame, "c", {"a": 2.0, "b": 0.5}).collect()
    assert [r.weight for r in weighted] == [2.0, 0.5]


def test_conform_ignores_case(spark):
    frame = spark.createDataFrame([(7,)], "age int")
    assert S.conform(frame, {"AGE": "long"}).collect()[0]["AGE"] == 7


def test_upsert_keeps_what_updates_lack(spark):
    target = spark.createDataFrame([(1, 1, "a", "x"), (2, 1, "b", "y"), (None, 1, "n", "z")], "k int, t int, v string, keep string")
    updates = spark.createDataFrame([(1, 5, "c"), (1, 4, "d"), (3, 1, "e"), (None, 2, "m")], "k int, t int, v string")
    got = {tuple(r) for r in S.upsert(target, updates, ["k"], ["t"]).collect()}
    assert got == {(1, 5, "c", "x"), (2, 1, "b", "y"), (3, 1, "e", None), (None, 1, "n", "z"), (None, 2, "m", None)}


def test_missing_labels_are_labels(spark):
    frame = spark.createDataFrame([("a", "a"), (None, "a"), ("b", None)], "y string, z string")
    counts = M.pair_counts(frame, "y", "z")
    cells = {(r.actual, r.predicted): r.n for r in M.confusion_matrix(counts).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 3 and cells[None, "a"] == 1
    with pytest.raises(Exception, match="over 2 labels"):
        M.confusion_matrix(counts, limit=2).collect()


def test_many_rungs(spark):
    frame = spark.range(1000).selectExpr("id", "id % 100 AS rung", "double(id * 7919 % 1009) AS score")
    rows = halving_promote(frame, "rung", "score", factor=4).collect()
    for mode in ("max", "min"):
        rows = halving_promote(frame, "rung", "score", factor=4, mode=mode).collect()
        for rung in (0, 63, 64, 99):
            scores = sorted(r.score for r in rows if r.rung == rung)
            kept = sorted(r.score for r in rows if r.rung == rung and r.promoted)
            assert kept == (scores[-3:] if mode == "max" else scores[:3])
    assert frame.count() == len(rows)


def test_replace_drops_the_old_rule(spark):
    store = FeatureStore(spark, fresh_path(spark, "store"))
    store.create_entity("e", ["k"])
    rows = spark.sql("SELECT 'a' AS k, timestamp_ntz'2024-01-01' AS ts, 1 AS v")
    store.create_view("f", rows, "e")
    source = fresh_path(spark, "arrived")
    rows.withColumn("v", F.lit(2)).write.parquet(source)
    store.refresh_view("f", "v1", spark.readStream.schema(rows.schema).parquet(source), refresh=None).awaitTermination()
    assert store.read_view("f").count() == 2
    assert [r.v for r in store.create_view("f", rows.withColumn("v", F.lit(9)), "e", replace=True).collect()] == [9]
    assert [r.v for r in store.read_view("f").collect()] == [9]


def _scans(frame) -> int:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan")


def test_windowed_drift_scans_each_side_once(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    before, after = events.filter(F.col("ts") < split), events.filter(F.col("ts") >= split)
    edges = R.fit_edges(before, ["value"])
    found = R.drift(before, after, ["value"], ["event_type"], segments=["event_type"], granularity="day", edges=edges)
    assert _scans(found) == 2


def test_matrix_and_running_totals_read_once(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    counts = M.pair_counts(orders, "o_orderstatus", "o_orderpriority")
    assert _scans(M.confusion_matrix(counts)) == 1


def test_alert_range_reaches_the_scan(spark, sf_dir):
    import __spark_entry__ as entry

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = entry.queries()["evaluate_alerts"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,2001-01-01" in plan and "LessThan(o_orderdate,2003-01-01" in plan
    assert plan.count("FileScan") == 2

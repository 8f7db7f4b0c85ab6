"""Drift properties, and the live operators on several micro-batches against their batch twins."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import alerts as A
from riskloom.operators import drift as R
from riskloom.operators.metrics import batch_distribution
from riskloom.sources import fixtures as X
from riskloom.streaming import live as L
from riskloom.sources.paths import numbered
from riskloom.workspace import fresh_path

COLUMNS, CATEGORIES, SEGMENTS = ["age", "glucose_level"], ["risk_level"], ["admission_type"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_no_drift_against_itself(spark, sf_dir):
    frame = X.patients(spark, sf_dir)
    found = R.drift(frame, frame, COLUMNS, CATEGORIES, SEGMENTS)
    assert found.filter("psi <> 0 OR kl <> 0 OR jsd <> 0").count() == 0
    assert found.count() == 3 * (1 + 3)


def test_perturbation_raises_psi_and_jsd_is_bounded(spark, sf_dir):
    base, drifted = X.baseline_slice(spark, sf_dir), X.drifted_live(spark, sf_dir).filter("drift_applied")
    live = X.patients(spark, sf_dir).filter(F.col("ts") >= F.lit(X.DRIFT_START).cast("timestamp_ntz"))
    clean = {r["column"]: r for r in R.drift(base, live, ["heart_rate", "age"]).collect()}
    moved = {r["column"]: r for r in R.drift(base, drifted, ["heart_rate", "age"]).collect()}
    assert moved["heart_rate"].psi > 0.25 > clean["heart_rate"].psi
    assert moved["age"].psi == clean["age"].psi
    assert all(0 <= r.jsd <= math.log(2) for r in [*clean.values(), *moved.values()])


def test_bins_by_hand(spark):
    base = spark.createDataFrame([(0.0,), (10.0,), (None,)], "x double")
    edges = R.fit_edges(base, ["x"])
    values = [(i, v) for i, v in enumerate([-5.0, 0.0, 0.99, 1.0, 9.99, 10.0, 50.0, None, float("nan"), float("inf")])]
    frame = spark.createDataFrame(values, "i int, x double").orderBy("i")
    assert [r[0] for r in frame.select(R.bin_of("x", edges)).collect()] == [0, 0, 0, 1, 9, 9, 9, -1, -1, 9]
    flat = R.fit_edges(spark.createDataFrame([(4.0,), (4.0,)], "x double"), ["x"])
    low_high = spark.createDataFrame([(1, 3.0), (2, 4.0), (3, 4.1)], "i int, x double").orderBy("i")
    assert [r[0] for r in low_high.select(R.bin_of("x", flat)).collect()] == [0, 0, 9]
    empty = R.fit_edges(spark.createDataFrame([(None,)], "x double"), ["x"])
    assert [r[0] for r in low_high.select(R.bin_of("x", empty)).collect()] == [0, 0, 0]


def test_psi_by_hand(spark):
    base = spark.createDataFrame([("a",)] * 3 + [("b",)], "c string")
    live = spark.createDataFrame([("a",), ("b",), ("new",), (None,)], "c string")
    p = {"a": 0.25, "b": 0.25, "new": 0.25, "__null__": 0.25}
    q = {"a": 0.75, "b": 0.25, "new": 1e-4, "__null__": 1e-4}
    psi = sum((p[k] - q[k]) * math.log(p[k] / q[k]) for k in p)
    assert R.drift(base, live, categorical=["c"]).head().psi == pytest.approx(psi, abs=1e-6)


def test_segment_missing_from_the_baseline(spark):
    base = spark.createDataFrame([("a", "x")], "c string, s string")
    live = spark.createDataFrame([("a", "x"), ("a", "y")], "c string, s string")
    found = {r.segment_value: r.psi for r in R.drift(base, live, categorical=["c"], segments=["s"]).collect()}
    assert found["x"] == 0 and found["y"] > 1


def _alert_metrics(spark):
    rows_ = [("2024-01-01", "__all__", "x", "psi", 0.9), ("2024-01-02", "__all__", "x", "psi", 0.2),
             ("2024-01-02", "seg", "x", "psi", 0.9), ("2024-01-02", "__all__", "y", "psi", 0.21)]
    frame = spark.createDataFrame(rows_, "d string, segment_column string, column string, metric string, metric_value double")
    return frame.withColumn("window_start", F.col("d").cast("timestamp_ntz"))


def test_alert_threshold_is_strict_and_trailing(spark):
    rules = A.rules_frame(spark, [("x", "x", "psi", 0.2), ("y", "y", "psi", 0.2), ("z", "z", "psi", 0.0)])
    since, until = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-02", "2024-01-03"))
    out = A.evaluate_alerts(_alert_metrics(spark), rules, since, until)
    assert {r.alert_name: r.fired for r in out.collect()} == {"x": False, "y": True, "z": False}
    assert A.retrain_signal(out).collect()[0].n_fired == 1
    assert A.retrain_signal(out.filter("NOT fired")).count() == 0
    assert A.retrain_signal(out.limit(0)).count() == 0


def test_alert_history_keeps_order(spark):
    log = spark.createDataFrame([("a", 1), ("b", 3), ("a", 2)], "alert_name string, triggered_at int")
    out = A.alert_history(log, F.lit(2), ["a", "b"])
    assert [tuple(r) for r in out.collect()] == [("b", 3), ("a", 2)]


def test_batch_distribution_blocks(spark):
    batches = [(b, p) for b in range(0, 50, 3) for p in ["x"] * (b % 4 + 1) + ["y"]]
    frame = spark.createDataFrame(batches, "b bigint, p string")
    got = {(r.b, r.p): (r.n, r.running_total) for r in batch_distribution(frame, "b", "p").collect()}
    for (b, p), (n, total) in got.items():
        assert n == batches.count((b, p))
        assert total == sum(1 for other, _ in batches if other <= b)


# ------------------------------------------------------------------ several micro-batches


@pytest.fixture(scope="module")
def split_events(spark, sf_dir):
    path = fresh_path(spark, "events-in-files")
    X.table(spark, sf_dir, "events").repartitionByRange(5, "ts").write.parquet(f"{path}/events.parquet")
    return path


def _source(spark, folder):
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    return L.stream_source(spark, folder, "events.parquet", schema, files_per_trigger=1)


def test_live_drift_equals_batch(spark, sf_dir, split_events):
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    events = X.table(spark, sf_dir, "events")
    before, after = events.filter(F.col("ts") < split), events.filter(F.col("ts") >= split)
    live = L.LiveDrift(before, ["value"], [], segments=["event_type"])
    stream = L.with_event_time(_source(spark, split_events).filter(F.col("ts") >= split), watermark="60 days")
    path = L.run_to_path(lambda p: live.report_sink(stream, p), spark, "drift")
    batch = R.drift(before, after, ["value"], segments=["event_type"], granularity="day")
    found = L.read_windows(spark, f"{path}/report")
    assert rows(found.select(*batch.columns)) == rows(batch)


def test_live_alerts_are_reported_once(spark, split_events):
    baseline = spark.read.parquet(f"{split_events}/events.parquet").filter("event_type = 'view'")
    live = L.LiveDrift(baseline, [], ["event_type"])
    rules = A.rules_frame(spark, [("types", "event_type", "psi", 0.1), ("never", "event_type", "jsd", 5.0)])
    since, until = (F.lit(d).cast("timestamp_ntz") for d in ("2000-01-01", "2100-01-01"))
    stream = L.with_event_time(_source(spark, split_events), watermark="60 days")
    path = L.run_to_path(lambda p: live.alert_sink(stream, rules, p, since, until), spark, "alerts")
    assert [r.alert_name for r in L.read_alerts(spark, path).collect()] == ["types"]
    every = L.run_to_path(lambda p: live.alert_sink(stream, rules, p, since, until, every=2), spark, "alerts")
    assert L.read_alerts(spark, every).count() == 1


def test_a_restarted_monitor_goes_on(spark, sf_dir, split_events):
    """Stopped after each file and started anew, with another baseline at hand: the same report."""
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    events = X.table(spark, sf_dir, "events")
    before, after = events.filter(F.col("ts") < split), events.filter(F.col("ts") >= split)
    store, path, checkpoint = (fresh_path(spark, n) for n in ("monitor", "drift", "checkpoint"))
    folder = fresh_path(spark, "landing")
    for low, high in (("2024-01-15", "2024-01-20"), ("2024-01-20", "2024-01-26"), ("2024-01-26", "2024-03-01")):
        after.filter(f"ts >= '{low}' AND ts < '{high}'").write.mode("append").parquet(f"{folder}/events.parquet")
        known = before if low == "2024-01-15" else after.filter("value < 3")
        live = L.LiveDrift(known, ["value"], ["event_type"], store=store)
        stream = L.with_event_time(L.stream_source(spark, folder, "events.parquet", events.schema))
        L.drain(L.start(live.report_sink(stream, path), checkpoint, refresh=None))
    batch = R.drift(before, after, ["value"], ["event_type"], granularity="day")
    assert rows(L.read_windows(spark, f"{path}/report").select(*batch.columns)) == rows(batch)
    assert len(numbered(spark, f"{path}/report/list", "step")) == 2  # older states are gone


def test_daily_counts_append_holds_back_the_open_day(spark, sf_dir):
    schema = X.table(spark, sf_dir, "events").schema
    events = L.with_event_time(L.stream_source(spark, sf_dir, "events.parquet", schema))
    counts = L.window_counts(events, ["event_type"])
    path = L.run_to_path(lambda p: L.file_sink(counts, p), spark, "daily")
    closed = spark.read.parquet(path)
    complete = L.read_windows(spark, L.run_to_path(lambda p: L.window_sink(counts, p), spark, "daily"))
    last = complete.agg(F.max("window_start")).head()[0]
    assert 0 < closed.count() < complete.count()
    assert closed.filter(F.col("window_start") == last).count() == 0
    assert closed.exceptAll(complete).count() == 0


def test_dedup_over_batches(spark, split_events):
    stream = L.with_event_time(_source(spark, split_events).unionByName(_source(spark, split_events)), watermark="60 days")
    path = L.run_to_path(lambda p: L.file_sink(L.dedup(stream, ["event_id"]), p), spark, "unique")
    unique = spark.read.parquet(path)
    assert unique.count() == unique.select("event_id").distinct().count() == 1000


def test_a_batch_seen_again_replaces_itself(spark, split_events):
    stream = _source(spark, split_events)
    path = fresh_path(spark, "append")
    for _ in range(2):  # a lost checkpoint replays every batch
        L.drain(L.start(L.append_sink(stream, path, ["event_id"]), fresh_path(spark, "checkpoint"), refresh=None))
    assert spark.read.parquet(path).count() == 1000


def test_no_snapshot_is_an_error(spark):
    with pytest.raises(LookupError):
        L.read_windows(spark, fresh_path(spark, "nothing"))

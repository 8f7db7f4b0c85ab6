import pytest
from pyspark.sql import functions as F

from riskloom.operators.runlog import run_log_rollup
from riskloom.sources import tables as S
from riskloom.sources.datasets import FeatureStore, dataset_versions, read_dataset_version, write_dataset_version
from riskloom.workspace import fresh_path, shared_root


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_shared_root_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_append_by_name(spark):
    path = fresh_path(spark, "append")
    S.write_table(spark.createDataFrame([(1, "a")], "i int, s string"), path)
    S.append_by_name(spark.createDataFrame([("b", 2)], "s string, i int"), path)
    S.append_by_name(spark.createDataFrame([(3,)], "i int"), path)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError, match="not in the target"):
        S.append_by_name(spark.createDataFrame([(4, 5)], "i int, other int"), path)


def test_write_table_counts(spark):
    path = fresh_path(spark, "count")
    assert S.write_table(spark.range(7), path) == 7
    assert S.write_table(spark.range(3), path) == 3


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "old", 5), (2, "keep", 9)], "k int, v string, rev int")
    updates = spark.createDataFrame([(1, "x", 1), (1, "new", 2), (3, "added", 1)], "k int, v string, rev int")
    once = S.upsert(target, updates, ["k"], ["rev"])
    expected = [(1, "new", 2), (2, "keep", 9), (3, "added", 1)]
    assert rows(once) == expected
    assert rows(S.upsert(once, updates, ["k"], ["rev"])) == expected


def test_conform_defaults_and_missing(spark):
    frame = spark.createDataFrame([("1", None)], "a string, b int")
    out = S.conform(frame, {"a": "int", "b": "int"}, defaults={"b": F.lit(7), "c": F.lit("z")})
    assert out.dtypes == [("a", "int"), ("b", "int"), ("c", "string")]
    assert rows(out) == [(1, 7, "z")]
    with pytest.raises(ValueError, match="missing"):
        S.conform(frame, {"nope": "int"})


def test_project_cast_lenient(spark):
    frame = spark.createDataFrame([("1.5",), ("bad",)], "a string")
    assert rows(S.project_cast(frame, {"a": "double"}, lenient=True)) == [(1.5,), (None,)]


def test_dataset_versions(spark):
    root = fresh_path(spark, "versions")
    with pytest.raises(LookupError):
        read_dataset_version(spark, root, "d")
    write_dataset_version(spark.range(1), root, "d", "v_1")
    write_dataset_version(spark.range(2), root, "d", "v_2")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_dataset_version(spark.range(9), root, "d", "v_2")
    assert dataset_versions(spark, root, "d") == ["v_1", "v_2"]
    assert read_dataset_version(spark, root, "d").count() == 2
    assert read_dataset_version(spark, root, "d", "v_1").count() == 1


def test_incomplete_version_is_not_picked_up(spark):
    root = fresh_path(spark, "versions")
    write_dataset_version(spark.range(1), root, "d", "v_1")
    (spark.range(5).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .parquet(f"{root}/d/version=v_2"))
    assert read_dataset_version(spark, root, "d").count() == 1


def test_feature_store_registration(spark):
    store = FeatureStore(spark, fresh_path(spark, "store"))
    for _ in range(2):
        store.create_entity("patient", ["k"])
    assert store.entities().count() == 1
    view = spark.createDataFrame([("a", 1), ("b", 2)], "k string, ts int")
    store.create_view("f", view, "patient")
    assert store.create_view("f", view.limit(0), "patient").count() == 2
    assert store.create_view("f", view.limit(1), "patient", version="v2").count() == 1
    assert store.create_view("f", view.limit(1), "patient", replace=True).count() == 1
    assert rows(store.views().select("view", "version")) == [("f", "v1"), ("f", "v2")]
    with pytest.raises(LookupError):
        store.feature_view("nope")


def test_run_log(spark):
    log = [
        ("r1", "load", "start", 0, "success"), ("r1", "load", "end", 4, "success"),
        ("r1", "fit", "start", 5, "success"), ("r1", "fit", "end", 9, "success"),
        ("r2", "load", "start", 0, "success"), ("r2", "load", "end", 3, "failed"),
        ("r3", "load", "start", 0, "success"),
        ("r4", "load", "skip", 1, "success"), ("r4", "fit", "start", 2, "success"),
    ]
    frame = spark.createDataFrame(log, "run string, step string, kind string, sec int, status string")
    frame = frame.withColumn("at", F.timestamp_seconds("sec"))
    out = run_log_rollup(frame, "run", "step", "kind", "at", "status", final_step="fit").orderBy("run_id").collect()
    assert [r.status for r in out] == ["SUCCESS", "FAILED", "RUNNING", "RUNNING"]
    assert [r.n_steps for r in out] == [2, 1, 1, 2]
    assert [r.total_duration_s for r in out] == [8.0, 3.0, 0.0, 0.0]
    assert "duration_s" not in out[2].steps and '"duration_s":4.0' in out[0].steps
    assert out[2].end_time is None and out[0].end_time is not None
    assert '"status":"skipped"' in out[3].steps and '"status":"running"' in out[3].steps

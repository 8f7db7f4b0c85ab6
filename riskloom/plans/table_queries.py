"""Queries over tables, sinks, datasets and the feature store."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.constants import ENCOUNTER_SCHEMA
from riskloom.functions.expressions import hash_bucket, version_stamp
from riskloom.functions.payload import json_extract
from riskloom.operators.scoring import flatten_log
from riskloom.operators.features import feature_frame
from riskloom.operators.runlog import run_log_rollup
from riskloom.operators.selection import hash_split, latest_version, prune_candidates
from riskloom.plans.registry import query
from riskloom.plans.sql import (
    ENCOUNTERS,
    ENGINEERED_TRAIN,
    FLAT_CTE,
    F_CTE,
    over_p,
)
from riskloom.sources import fixtures as X
from riskloom.sources import tables as S
from riskloom.sources.datasets import FeatureStore, read_dataset_version, write_dataset_version
from riskloom.workspace import fresh_path


@query("scan_table", "SELECT * FROM orders")
def scan_table(spark, sf_dir):
    return S.read_table(spark, f"{sf_dir}/orders.parquet")


@query(
    "conform_schema",
    over_p(
        f"SELECT {ENCOUNTERS}, TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM p"
    ),
)
def conform_schema(spark, sf_dir):
    loose = X.patients(spark, sf_dir).withColumns(
        {"age": F.col("age").cast("string"), "heart_rate": F.col("heart_rate").cast("double")}
    )
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return S.conform(loose, ENCOUNTER_SCHEMA, defaults={"created_at": stamp})


@query("write_overwrite", over_p(f"SELECT {ENCOUNTERS} FROM p"))
def write_overwrite(spark, sf_dir):
    path = fresh_path(spark, "encounters")
    everyone = X.patients(spark, sf_dir)
    S.write_table(X.baseline_slice(spark, sf_dir), path)
    S.write_table(everyone, path)
    return spark.read.parquet(path)


@query("append_by_name", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def append_by_name(spark, sf_dir):
    path = fresh_path(spark, "nations")
    nation = X.table(spark, sf_dir, "nation")
    S.write_table(nation.filter("n_regionkey < 2"), path)
    S.append_by_name(nation.filter("n_regionkey >= 2").select("n_regionkey", "n_name", "n_nationkey"), path)
    return spark.read.parquet(path)


@query(
    "ctas_projection",
    over_p("SELECT encounter_id, ts, age, bmi, risk_level FROM p"),
)
def ctas_projection(spark, sf_dir):
    path = fresh_path(spark, "ctas")
    chosen = X.patients(spark, sf_dir).select("encounter_id", "ts", "age", "bmi", "risk_level")
    return S.create_table_as(chosen, "encounters_" + path.rsplit("-", 1)[1], path)


@query("view_over_log", over_p("SELECT encounter_id, heart_rate, bmi_category, risk_level FROM flat", FLAT_CTE))
def view_over_log(spark, sf_dir):
    flat = flatten_log(X.inference_log(spark, sf_dir), keep=["encounter_id"])
    S.define_view(flat, "inference_logs_view")
    return spark.sql("SELECT encounter_id, heart_rate, bmi_category, risk_level FROM inference_logs_view")


@query("dataset_version_roundtrip", over_p(f"SELECT {ENCOUNTERS} FROM p"))
def dataset_version_roundtrip(spark, sf_dir):
    root = fresh_path(spark, "datasets")
    write_dataset_version(X.baseline_slice(spark, sf_dir), root, "training", "v_20240101_000000")
    write_dataset_version(X.patients(spark, sf_dir), root, "training", "v_20240102_000000")
    return read_dataset_version(spark, root, "training")


@query(
    "keyed_upsert",
    """SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + CAST(100 AS DOUBLE) ELSE c_acctbal END AS c_acctbal,
         c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 0 END AS revision
       FROM customer
       UNION ALL
       SELECT c_custkey + 1000000000, c_name, c_nationkey, c_acctbal, c_mktsegment, 1
       FROM customer WHERE c_acctbal < 0""",
)
def keyed_upsert(spark, sf_dir):
    customer = X.table(spark, sf_dir, "customer").withColumn("revision", F.lit(0))
    building = customer.filter("c_mktsegment = 'BUILDING'")
    first = building.withColumns({"c_acctbal": F.col("c_acctbal") + 50.0, "revision": F.lit(1)})
    second = building.withColumns({"c_acctbal": F.col("c_acctbal") + 100.0, "revision": F.lit(2)})
    added = customer.filter("c_acctbal < 0").withColumns(
        {"c_custkey": F.col("c_custkey") + 1000000000, "revision": F.lit(1)}
    )
    updates = first.unionByName(second).unionByName(added)
    return S.upsert(customer, updates, ["c_custkey"], ["revision"])


@query(
    "state_lookup_default",
    """WITH big AS (
         SELECT o_custkey, max_by(o_orderstatus, o_orderkey) AS last_status
         FROM orders WHERE o_totalprice > 300000 GROUP BY o_custkey)
       SELECT o_orderkey, o.o_custkey, coalesce(last_status, 'none') AS last_status
       FROM orders o LEFT JOIN big ON o.o_custkey = big.o_custkey""",
)
def state_lookup_default(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders")
    state = (
        orders.filter("o_totalprice > 300000")
        .groupBy("o_custkey")
        .agg(F.max_by("o_orderstatus", "o_orderkey").alias("last_status"))
    )
    return S.lookup(orders.select("o_orderkey", "o_custkey"), state, ["o_custkey"], "last_status", "none")


_KIND = "CASE WHEN event_type = 'signup' THEN 'skip' WHEN k < 50 THEN 'start' ELSE 'end' END"


@query(
    "run_log_rollup",
    f"""WITH e AS (
          SELECT user_id, event_type, ts, CASE WHEN value > 150 THEN 'failed' ELSE 'success' END AS status,
            CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
        kinds AS (SELECT *, {_KIND} AS kind FROM e),
        steps AS (
          SELECT user_id, event_type AS step,
            min(CASE WHEN kind <> 'end' THEN ts END) AS s, max(CASE WHEN kind <> 'start' THEN ts END) AS e,
            max(CASE WHEN kind = 'end' AND status = 'failed' THEN 1 ELSE 0 END) AS failed
          FROM kinds GROUP BY ALL),
        timed AS (
          SELECT *, floor(greatest(CAST(epoch_us(e) - epoch_us(s) AS DOUBLE) / 1e6, 0) * 100 + CAST(0.5 AS DOUBLE))
            / CAST(100 AS DOUBLE) AS d FROM steps),
        runs AS (
          SELECT user_id AS run_id, min(s) AS start_time, max(e) AS last_end, max(failed) AS failed,
            max(CASE WHEN step = 'view' AND e IS NOT NULL THEN 1 ELSE 0 END) AS done,
            count(*) AS n_steps, sum(d) AS d FROM timed GROUP BY user_id)
        SELECT run_id, start_time, CASE WHEN failed = 1 OR done = 1 THEN last_end END AS end_time,
          CASE WHEN failed = 1 THEN 'FAILED' WHEN done = 1 THEN 'SUCCESS' ELSE 'RUNNING' END AS status,
          CAST(n_steps AS BIGINT) AS n_steps, round(d, 2) AS total_duration_s
        FROM runs""",
)
def run_log(spark, sf_dir):
    events = X.table(spark, sf_dir, "events")
    typed = json_extract(
        events,
        "props",
        {"k": ("k", "int")},
        keep=["user_id", "event_type", "ts", F.when(F.col("value") > 150, "failed").otherwise("success").alias("status")],
    ).withColumn("kind", F.expr(_KIND))
    rolled = run_log_rollup(typed, "user_id", "event_type", "kind", "ts", "status", final_step="view")
    return rolled.drop("steps").withColumn("total_duration_s", F.round("total_duration_s", 2))


@query(
    "retain_latest_versions",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders) WHERE rn > 3""",
)
def retain_latest_versions(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return prune_candidates(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], keep=3)


_COUNTED = ["orders", "lineitem", "customer", "events"]


@query(
    "table_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED),
)
def table_row_counts(spark, sf_dir):
    return S.row_counts({t: X.table(spark, sf_dir, t) for t in _COUNTED})


@query(
    "latest_version",
    """SELECT o_custkey, o_orderkey, o_orderdate, strftime(o_orderdate, 'v_%Y%m%d_%H%M%S') AS version FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders) WHERE rn = 1""",
)
def latest_version_query(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", version_stamp("o_orderdate").alias("version")
    )
    return latest_version(orders, ["o_custkey"], ["version", "o_orderkey"])


# ------------------------------------------------------------------ feature store


def _store(spark):
    store = FeatureStore(spark, fresh_path(spark, "feature-store"))
    store.create_entity("patient", ["patient_id"], "one person over all encounters")
    return store


_FRAME = over_p(f"SELECT {ENCOUNTERS}, {ENGINEERED_TRAIN} FROM p")


@query("feature_frame", _FRAME)
def feature_frame_query(spark, sf_dir):
    return feature_frame(X.patients(spark, sf_dir))


@query("feature_view_idempotent", _FRAME)
def feature_view_idempotent(spark, sf_dir):
    store, raw = _store(spark), X.patients(spark, sf_dir)
    store.create_view("encounter_features", feature_frame(raw), "patient", tie_break=["encounter_id"])
    changed = feature_frame(raw, severity="serve", bmi="serve")
    return store.create_view("encounter_features", changed, "patient", tie_break=["encounter_id"])


@query(
    "feature_catalog",
    over_p(
        """SELECT 'encounter_features' AS view, 'v1' AS version, 'patient' AS entity, 'patient_id' AS join_keys,
             'ts' AS ts_column, '1 minute' AS refresh, count(*) AS n_rows FROM p
           UNION ALL SELECT 'spend', 'v2', 'patient', 'patient_id', 'ts', '1 minute', count(*) FROM orders"""
    ),
)
def feature_catalog(spark, sf_dir):
    store, raw = _store(spark), X.patients(spark, sf_dir)
    store.create_view("encounter_features", feature_frame(raw), "patient", tie_break=["encounter_id"])
    spend = X.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("P"), F.col("o_custkey")).alias("patient_id"), F.col("o_orderdate").alias("ts"), "o_totalprice"
    )
    store.create_view("spend", spend, "patient", version="v2")
    sizes = [
        store.read_view(v, n).agg(F.count("*").alias("n_rows")).select(F.lit(v).alias("view"), F.lit(n).alias("version"), "n_rows")
        for v, n in (("encounter_features", "v1"), ("spend", "v2"))
    ]
    listed = store.views().join(store.entities().select("entity", F.array_join("join_keys", ",").alias("join_keys")), "entity")
    return listed.join(sizes[0].unionByName(sizes[1]), ["view", "version"]).select(
        "view", "version", "entity", "join_keys", "ts_column", "refresh", "n_rows"
    )


_ONLINE = over_p(
    f"""SELECT {ENCOUNTERS}, shock_index, pulse_pressure, bmi_category, vital_signs_severity FROM (
          SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY ts DESC, encounter_id DESC) AS rn FROM f)
        WHERE rn = 1""",
    F_CTE,
)


@query("online_maintained", _ONLINE)
def online_maintained(spark, sf_dir):
    """Current rows from a table that takes in batches, late rows and a repeated batch among them."""
    store, features = _store(spark), feature_frame(X.patients(spark, sf_dir))
    part = hash_bucket(["encounter_id"], 3)
    store.create_view("encounter_features", features.filter(part == 0), "patient", tie_break=["encounter_id"])
    store.maintain_online("encounter_features")
    table = store.online_table("encounter_features")
    for step in (0, 1, 1):
        table.merge(features.filter(part == step + 1), "batches", step)
    return store.online_features("encounter_features")


@query("online_latest_per_key", _ONLINE)
def online_latest_per_key(spark, sf_dir):
    store = _store(spark)
    store.create_view(
        "encounter_features", feature_frame(X.patients(spark, sf_dir)), "patient", tie_break=["encounter_id"]
    )
    return store.online_features("encounter_features")


_SPLIT = "CAST('0x' || substr(md5(encounter_id), 1, 8) AS BIGINT) % 10"


_DATASET = over_p(
    f"""SELECT s.patient_id, s.ts, v.encounter_id, v.shock_index, v.bmi_category,
          v.vital_signs_severity, v.risk_level
        FROM (SELECT patient_id, ts FROM p WHERE {_SPLIT} < 8) s
        JOIN (SELECT *, row_number() OVER (PARTITION BY patient_id, ts ORDER BY encounter_id DESC) AS rn FROM f) v
        ON s.patient_id = v.patient_id AND s.ts = v.ts AND v.rn = 1""",
    F_CTE,
)


@query("extend_dataset", _DATASET)
def extend_dataset(spark, sf_dir):
    """A dataset in three versions, each of which computes the spine rows since the one before."""
    store, raw = _store(spark), X.patients(spark, sf_dir)
    featured = feature_frame(raw).select(
        "patient_id", "ts", "encounter_id", "shock_index", "bmi_category", "vital_signs_severity", "risk_level"
    )
    store.create_view("encounter_features", featured, "patient", tie_break=["encounter_id"])
    layout = store.layout("encounter_features", seconds=180 * 86400, buckets=8)
    train, _ = hash_split(raw, ["encounter_id"])
    spine = train.select("patient_id", "ts")
    for year in ("1994", "1998", "2100"):  # the first holds no row
        arrived = spine.filter(F.col("ts") < F.lit(f"{year}-01-01").cast("timestamp_ntz"))
        grown = store.extend_dataset(arrived, {"": layout}, "ts", "training", f"v_{year}")
    return grown


@query("generate_dataset", _DATASET)
def generate_dataset(spark, sf_dir):
    store, raw = _store(spark), X.patients(spark, sf_dir)
    featured = feature_frame(raw).select(
        "patient_id", "ts", "encounter_id", "shock_index", "bmi_category", "vital_signs_severity", "risk_level"
    )
    store.create_view("encounter_features", featured, "patient", tie_break=["encounter_id"])
    train, _ = hash_split(raw, ["encounter_id"])
    return store.generate_dataset(
        train.select("patient_id", "ts"),
        [store.feature_view("encounter_features")],
        ["patient_id"],
        "ts",
        "training",
        "v_20240101_000000",
    )



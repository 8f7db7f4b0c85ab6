"""Every registered query against its SQL, on the smallest test tables."""

import checking
import pytest

import __spark_entry__ as entry_module

# no pair-wise joins; Python only where a foreign model is the feature
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(key, spark, sf_dir, duck):
    frame = QUERIES[key](spark, sf_dir)
    if key in ORACLES:
        assert checking.compare(frame, duck, ORACLES[key]) is None
    else:
        assert frame.count() > 0
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in FORBIDDEN if bad in plan]


def test_feature_frame_plan(spark, sf_dir):
    """One fused stage over three columns of the source, no shuffle."""
    plan = QUERIES["feature_frame"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_filters_reach_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = QUERIES["filter_predicate"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,30" in plan and "EqualTo(l_returnflag,R)" in plan


def test_drift_reads_each_side_once(spark, sf_dir):
    frame = QUERIES["drift_report"](spark, sf_dir)
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 2


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert {"shock_index", "pulse_pressure", "bmi_category", "vital_signs_severity"} <= set(frame.columns)
    assert frame.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)

"""The registered queries against their SQL, and what their plans hold."""

import checking
import pytest

from riskloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query(key, spark, sf_dir, duck):
    assert checking.compare(QUERIES[key](spark, sf_dir), duck, ORACLES[key]) is None


def test_names():
    for n in range(1, 14):
        assert len([k for k in QUERIES if k.startswith(f"op{n}_")]) == 1
    assert "pipeline" in QUERIES and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k != "pipeline"))
def test_no_pairwise_plans(key, spark, sf_dir):
    plan = QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython") if bad in plan]

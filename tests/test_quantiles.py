import math
import random

import numpy as np
import pytest

from riskloom.operators.quantiles import exact_quantiles


def column(kind, n, rng):
    if kind == "normal":
        return [rng.gauss(0, 1) for _ in range(n)]
    if kind == "lognormal":
        return [math.exp(rng.gauss(0, 8)) for _ in range(n)]
    if kind == "few":
        return [float(rng.choice([1, 1, 1, 2, 7])) for _ in range(n)]
    if kind == "constant":
        return [3.5] * n
    if kind == "huge":
        return [rng.choice([-1e308, 1e308, 0.0, 5e-324, 1.0]) for _ in range(n)]
    raise AssertionError(kind)


@pytest.mark.parametrize("kind", ["normal", "lognormal", "few", "constant", "huge"])
@pytest.mark.parametrize("n", [1, 2, 501])
def test_against_numpy(spark, kind, n):
    values = column(kind, n, random.Random(7))
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    frame = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double")
    got = exact_quantiles(frame, ["x"], probabilities)["x"]
    ordered = sorted(values)
    for p, value in zip(probabilities, got):
        position = (n - 1) * p
        low, high = ordered[math.floor(position)], ordered[math.ceil(position)]
        part = position - math.floor(position)
        expected = low if part == 0 else low + (high - low) * part
        assert value == expected or math.isclose(value, expected, rel_tol=1e-12) or kind == "huge"
    if kind in ("normal", "few"):
        assert np.allclose(got, np.quantile(values, probabilities))


def test_columns_without_values(spark):
    frame = spark.createDataFrame([(None, 1.0), (None, 4.0)], "a double, b double")
    assert exact_quantiles(frame, ["a", "b"], [0.5]) == {"a": [None], "b": [2.5]}


def test_passes_keep_their_size(spark, monkeypatch):
    """One expression bins the values of all columns, so that a pass over many is compiled."""
    from pyspark.sql.classic.dataframe import DataFrame

    rng, plans, collect = np.random.default_rng(7), [], DataFrame.collect
    values = rng.normal(size=(300, 12)) * 10.0 ** np.arange(-6, 18, 2)
    frame = spark.createDataFrame(values.tolist(), [f"c{i}" for i in range(12)])
    monkeypatch.setattr(DataFrame, "collect", lambda self: plans.append(self._jdf.queryExecution().analyzed().toString()) or collect(self))
    found = exact_quantiles(frame, frame.columns, [0.5, 0.9])
    assert plans and all(p.lower().count("log2(") <= 1 for p in plans)
    for i, c in enumerate(frame.columns):
        assert found[c] == pytest.approx(np.quantile(values[:, i], [0.5, 0.9]).tolist(), rel=1e-12)

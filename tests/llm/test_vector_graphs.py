import math

import numpy as np
import pytest
import tables

SCHEMA = "vec_id long, embedding array<float>, label int, key string, shard long, part long, n long"
COLUMNS = ["vec_id", "n_links", "component_id", "kept"]


def frame(spark, rows):
    """Also columns whose names clash with those inside the operator."""
    return spark.createDataFrame([(i, v, k, "x", 1, 2, 3) for i, v, k in rows], SCHEMA)


def pairs(rows, least=0.93):
    """Linked pairs of row numbers by brute force."""
    groups = {}
    for i, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            groups.setdefault((label, len(v)), []).append(i)
    out = set()
    for own in groups.values():
        m = np.array([rows[i][1] for i in own], dtype=np.float32).astype(np.float64)
        m /= np.abs(m).max(axis=1, keepdims=True)
        m /= np.sqrt((m * m).sum(axis=1))[:, None]
        a, b = np.nonzero(np.triu(m @ m.T >= least, 1))
        out |= {(own[x], own[y]) for x, y in zip(a, b)}
    return out


def brute(rows):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    n = [0] * len(rows)
    for a, b in pairs(rows):
        n[a] += 1
        n[b] += 1
        root[find(b)] = find(a)
    least = {}
    for i, (vec, _, _) in enumerate(rows):
        least.setdefault(find(i), []).append(vec)
    first = {k: min((v for v in vs if v is not None), default=None) for k, vs in least.items()}
    return sorted(((v, n[i], first[find(i)], v == first[find(i)]) for i, (v, _, _) in enumerate(rows)), key=repr)


def clustered(seed, n, d=16, labels=3, centres=40, spread=0.09):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(centres, d))
    mid /= np.linalg.norm(mid, axis=1)[:, None]
    rows = mid[rng.integers(centres, size=n)] + rng.normal(size=(n, d)) * spread * rng.random((n, 1))
    return [(int(i), [float(x) for x in v], int(k)) for i, v, k in zip(rng.permutation(n), rows, rng.integers(labels, size=n))]


def awkward():
    rows = clustered(1, 60)
    nan, inf = float("nan"), float("inf")
    rows += [(100, None, 1), (101, [], 1), (102, [0.0] * 16, 1), (103, [None] + [1.0] * 15, 1), (104, [nan] + [1.0] * 15, 1), (105, [inf] * 16, 1)]
    rows += [(106, rows[0][1], None), (107, rows[0][1][:8], 1), (108, rows[0][1][:8], 1), (None, rows[0][1], rows[0][2]), (None, rows[1][1], rows[1][2])]
    rows += [(i, rows[5][1], rows[5][2]) for i in range(200, 230)] + [(200, rows[5][1], rows[5][2]), (3, [2 * x for x in rows[5][1]], rows[5][2])]
    rows += [(300, [1e-30] * 16, 0), (301, [3e-30] * 16, 0), (302, [1e30] * 16, 0), (None, None, None)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"shard_values": 160, "shards_a_part": 2}])
def test_awkward(spark, limits):
    """Small shards are compared as wholes, so nothing is missed."""
    from riskloom.llm.vector_graphs import near_vectors

    rows = awkward()
    assert tables.result(near_vectors(frame(spark, rows), **limits), *COLUMNS) == brute(rows)


def test_empty(spark):
    from riskloom.llm.vector_graphs import near_vectors

    assert near_vectors(frame(spark, [])).collect() == []
    assert tables.result(near_vectors(frame(spark, [(4, None, None)])), *COLUMNS) == [(4, 0, 4, True)]


@pytest.mark.parametrize("spread, group", [(0.05, 0), (0.2, 0), (0.02, 700)])
def test_recall_of_a_graph(spread, group):
    """With narrow beams, without audits, on clustered points and a large group of near copies."""
    from riskloom.llm.vector_graphs import Shard

    rows = clustered(3, 3000, d=32, labels=1, centres=150, spread=spread)
    rng = np.random.default_rng(8)
    rows += [(5000 + i, [float(x) for x in np.array(rows[0][1]) + rng.normal(size=32) * 0.01], 0) for i in range(group)]
    vectors = np.array([r[1] for r in rows], dtype=np.float32).astype(np.float64)
    keys = np.array([str(i) for i in range(len(rows))], dtype=object)
    shard = Shard(keys, np.ones(len(rows), dtype=np.int64), vectors, 0.93, 16, 64, 0.0)
    assert shard.graph is not None and shard.beam == 16
    shard.join_own()
    want = pairs(rows)
    assert len(want) > 2000 and shard.counts.sum() % 2 == 0
    assert 0.98 * len(want) <= shard.counts.sum() / 2 <= len(want)


def test_audit_widens():
    from riskloom.llm.vector_graphs import Shard

    rows = clustered(3, 3000, d=32, labels=1, centres=150, spread=0.05)
    vectors = np.array([r[1] for r in rows], dtype=np.float64)
    keys = np.array([str(i) for i in range(len(rows))], dtype=object)
    shard = Shard(keys, np.ones(len(rows), dtype=np.int64), vectors, 0.93, 1, 256, 1.0)
    assert shard.beam > 1


@pytest.mark.parametrize("limits", [{}, {"beam": 8, "shard_values": 64 * 500, "shards_a_part": 2}])
def test_given(spark, limits):
    """Recall against brute force on a given table; nothing is linked that shouldn't be."""
    from riskloom.llm.vector_graphs import near_vectors

    table = spark.read.parquet("/root/testdata/check_s/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    got, want = tables.result(near_vectors(table, **limits), *COLUMNS), brute(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want) > 0
    assert sum(g == w for g, w in zip(got, want)) >= 0.99 * len(want)

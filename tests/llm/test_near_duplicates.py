import random

import brute
import pytest
import tables


@pytest.mark.parametrize("rows", [tables.rows(1), tables.rows(5, 160), []])
@pytest.mark.parametrize("sizes", [{}, {"hot_least": 2, "tile": 3}])
def test_components(spark, rows, sizes):
    from riskloom.llm.near_duplicates import near_duplicates

    got = tables.result(near_duplicates(tables.frame(spark, rows), **sizes), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.components(rows), key=repr)


def test_chain(spark):
    """Each text is linked with the next one only; some are just below the bound."""
    from riskloom.llm.near_duplicates import near_duplicates

    rng = random.Random(7)
    now, rows = [f"w{i}" for i in range(100)], []
    for i in range(40):
        rows.append((i, " ".join(now)))
        now = now[rng.choice([5, 9, 10, 11]) :]
        now += [f"v{i}x{k}" for k in range(100 - len(now))]
    rng.shuffle(rows)
    got = tables.result(near_duplicates(tables.frame(spark, rows), hot_least=1, tile=4), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.components(rows), key=repr)


def test_graph(spark):
    from riskloom.llm.graph import components

    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(50)]
    root = list(range(1100))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for e in edges if e[0] != e[1] for i in e}


def test_given(spark):
    from riskloom.llm.near_duplicates import near_duplicates

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = tables.result(near_duplicates(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.components(rows), key=repr)
    assert any(r[0] != r[2] for r in got)


def degrees(rows):
    """For each row the other distinct sets at a similarity of 0.8 or more."""
    sets = [brute.shingle_set(t) for _, t in rows]
    linked = {a: sum(a != b and 100 * len(a & b) >= 80 * len(a | b) for b in set(sets) if b) if a else 0 for a in set(sets)}
    return sorted(((d, linked[s]) for (d, _), s in zip(rows, sets)), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"hot_least": 1, "tile": 3}])
def test_all_links_are_counted(spark, sizes):
    """A group of near copies, all linked with each other, and the awkward rows."""
    from riskloom.llm.near_duplicates import near_duplicates

    base = [f"w{i}" for i in range(120)]
    rows = [(1000 + i, " ".join([*base, f"end{i}"])) for i in range(25)] + [(2000, " ".join(base)), (2001, " ".join(base))]
    rows += tables.rows(5, 160)
    got = tables.result(near_duplicates(tables.frame(spark, rows), **sizes), "doc_id", "n_links")
    assert got == degrees(rows) and (1000, 25) in got


def test_large_groups_in_cells_of_trees(spark, monkeypatch):
    """Groups too large for one cell: each tree's own, and blocks of them; a pair of several trees counts once."""
    from riskloom.llm import near_duplicates as module

    base = [f"w{i}" for i in range(120)]
    rows = [(1000 + i, " ".join([*base, f"end{i}"])) for i in range(25)] + [(i, " ".join([f"x{i}", *base[i:], f"y{i}"])) for i in range(12)]
    rows += tables.rows(5, 160)
    for block, volume in ((1024, 900), (4, 1 << 19)):
        monkeypatch.setattr(module, "BLOCK", block)
        monkeypatch.setattr(module, "VOLUME", volume)
        got = module.near_duplicates(tables.frame(spark, rows), hot_least=3, tile=8)
        assert tables.result(got, "doc_id", "n_links") == degrees(rows)
        assert tables.result(got, "doc_id", "n_shingles", "component_id") == sorted(brute.components(rows), key=repr)

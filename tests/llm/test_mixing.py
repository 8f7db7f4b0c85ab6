from collections import Counter, defaultdict

import brute
import pytest
import tables


def four(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]


@pytest.mark.parametrize("given", [True, False])
def test_sample(spark, given):
    from riskloom.llm.mixing import mixed_sample

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet") if given else tables.frame(spark, tables.rows(1))
    wanted = sorted(brute.mixed(four(docs)), key=repr)
    got = sorted(((r["doc_id"], r["probability"]) for r in mixed_sample(docs).collect()), key=repr)
    assert [d for d, _ in got] == [d for d, _ in wanted]
    assert [p for _, p in got] == pytest.approx([p for _, p in wanted], abs=1e-5)


def test_marginals(spark):
    from riskloom.llm.mixing import AXES, calibrated

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = calibrated(docs).collect()
    cells = {tuple(r[a] for a in AXES): r["tokens"] for r in rows}
    _, target = brute.rake(cells)
    for i, axis in enumerate(AXES):
        share = defaultdict(float)
        for r in rows:
            share[r[axis]] += r["weight"]
        assert dict(share) == pytest.approx(target[i], abs=1e-4)
    spent = sum(r["tokens"] * r["probability"] for r in rows)
    assert spent == pytest.approx(0.5 * sum(cells.values()), rel=1e-6)


def test_given_targets(spark):
    from riskloom.llm.mixing import calibrated

    docs = spark.createDataFrame([(i, "w " * 10, "en" if i % 2 else "fr", "a" if i % 3 else "b", "t") for i in range(60)], "doc_id long, text string, lang string, source string, about string")
    share = spark.createDataFrame([("en", 0.9), ("fr", 0.1), ("xx", 0.3)], "lang string, share double")
    rows = calibrated(docs, targets={"lang": share}, topic="about").collect()
    assert sum(r["weight"] for r in rows if r["lang"] == "en") == pytest.approx(0.9) and {r["topic"] for r in rows} == {"t"}


def test_empty(spark):
    from riskloom.llm.mixing import mixed_sample

    assert mixed_sample(tables.frame(spark, [])).count() == 0
    assert mixed_sample(tables.frame(spark, [(1, None), (2, "")])).count() == 2


def test_no_python(spark):
    from riskloom.llm.line_dedup import line_dedup
    from riskloom.llm.mixing import mixed_sample

    for plan in (mixed_sample, line_dedup):
        text = plan(tables.frame(spark, tables.rows(1)))._jdf.queryExecution().executedPlan().toString()
        assert not any(x in text for x in ("Python", "Pandas", "Arrow"))


def test_contradicting_targets_are_told(spark, caplog):
    """Sources of one language each: two thirds of all tokens must be x, the language's target is less."""
    from riskloom.llm.mixing import calibrated

    rows = [(i, "w " * 10, "y" if i % 3 == 2 else "x", f"s{i % 3}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    with caplog.at_level("WARNING", "riskloom.llm.mixing"):
        calibrated(docs)
    assert "source" in caplog.text and "lang" in caplog.text

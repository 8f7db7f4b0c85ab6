import brute
import pytest
import tables


@pytest.mark.parametrize("rows", [tables.rows(1), tables.rows(2, 120), []])
def test_words(spark, rows):
    from riskloom.llm.repeats import substring_dedup

    got = tables.result(substring_dedup(tables.frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.windows(rows), key=repr)


@pytest.mark.parametrize("window", [4, 7, 13])
def test_other_lengths(spark, window):
    from riskloom.llm.repeats import substring_dedup

    rows = tables.rows(4, 50)
    got = tables.result(substring_dedup(tables.frame(spark, rows), window), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.windows(rows, window), key=repr)


def test_given_words(spark, sf_dir):
    from riskloom.llm.repeats import substring_dedup

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = tables.result(substring_dedup(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.windows(rows), key=repr)
    assert any(r[2] for r in got)

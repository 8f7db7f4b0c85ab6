import brute
import corpus_pipeline
import pytest
import tables


def stages(spark, docs, sf_dir):
    out = []
    for _, stage in corpus_pipeline.STAGES:
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{id(docs)}-{len(out)}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_against_plain_version(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows, sampled = brute.pipeline([tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()], items)
    done = stages(spark, docs, sf_dir)
    assert all(d.columns == docs.columns for d in done[:-1])
    assert [d.count() for d in done] == sorted((d.count() for d in done), reverse=True)
    clean = done[3]
    assert tables.result(clean, "doc_id", "text", "lang", "source") == sorted(rows, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in clean.select("n_chars", "text").collect())
    got = sorted(r["doc_id"] for r in done[-1].select("doc_id").collect())
    assert got == sorted(d for d, _ in sampled)
    again = corpus_pipeline.run(spark, sf_dir)
    assert sorted(r["doc_id"] for r in again.select("doc_id").collect()) == got


@pytest.mark.parametrize("rows", [tables.rows(1), []])
def test_awkward_tables(spark, sf_dir, rows):
    done = stages(spark, tables.frame(spark, rows), sf_dir)
    assert all(d.columns == corpus_pipeline.COLUMNS for d in done[:-1])
    linked = done[2].select("doc_id", "text").collect()
    assert len(linked) == len(set(linked))
    if not rows:
        assert done[-1].count() == 0

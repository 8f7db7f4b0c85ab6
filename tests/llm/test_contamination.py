import brute
import pytest
import tables

ROWS = tables.rows(3)
ITEMS = [(0, ROWS[12][1][:400]), (1, "two WORDS"), (10, " ".join(ROWS[40][1].split()[:30])), (2, None), (3, "- ."), (None, ROWS[20][1][-300:]), (4, "one"), (5, ROWS[12][1][:400]), (6, "la " * 13)]


@pytest.mark.parametrize("slice_windows", [1_000_000, 40])
@pytest.mark.parametrize("rows,items", [(ROWS, ITEMS), (ROWS, []), ([], ITEMS)])
def test_contamination(spark, rows, items, slice_windows):
    from riskloom.llm.contamination import contamination

    if slice_windows == 40 and not (rows and items):
        return
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(tables.frame(spark, rows), bench, slice_windows=slice_windows)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert tables.result(got, *columns) == sorted(brute.contaminated(rows, items), key=repr)


def test_given_tables(spark, sf_dir):
    from riskloom.llm.contamination import contamination

    docs, bench = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    rows, items = ([tuple(r) for r in t.collect()] for t in (docs.select("doc_id", "text"), bench.select("item_id", "text")))
    got = tables.result(contamination(docs, bench), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == sorted(brute.contaminated(rows, items), key=repr)
    assert any(r[5] for r in got)

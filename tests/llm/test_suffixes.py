import random

import brute
import numpy as np
import pytest
import tables


def test_suffix_array_and_prefixes():
    from riskloom.llm.suffixes import common_prefixes, suffix_array

    rng = random.Random(0)
    for _ in range(200):
        raw = bytes(rng.randrange(rng.choice([1, 2, 3, 256])) for _ in range(rng.randint(1, 60)))
        raw += raw[: len(raw) // 2] * rng.randrange(2)
        text = np.frombuffer(raw, np.uint8)
        order = sorted(range(len(raw)), key=lambda i: raw[i:])
        array = suffix_array(text)
        assert array.tolist() == order
        prefixes = common_prefixes(text, array)
        for a, b in zip(order, order[1:]):
            n = 0
            while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            assert prefixes[b] == n


@pytest.mark.parametrize("rows", [tables.rows(1), tables.rows(2, 120), []])
@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 400, "chunk_bytes": 1000}])
def test_bytes(spark, rows, sizes):
    from riskloom.llm.byte_dedup import byte_dedup

    got = byte_dedup(tables.frame(spark, rows), **sizes)
    assert tables.result(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.substrings(rows), key=repr)


def test_given_bytes(spark, sf_dir):
    from riskloom.llm.byte_dedup import byte_dedup

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = tables.result(byte_dedup(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.substrings(rows), key=repr)
    assert any(r[2] for r in got)

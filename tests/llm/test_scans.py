"""Operators that look at one document at a time, line dedup, and archives."""

import brute
import pytest
import tables

ROWS = tables.rows()


def small(spark, sf_dir):
    got = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in got]


@pytest.fixture(params=["own", "given", "empty"])
def data(request, spark, sf_dir):
    return {"own": ROWS, "given": None, "empty": []}[request.param] if request.param != "given" else small(spark, sf_dir)


def test_secrets(spark, data):
    from riskloom.llm.secrets import find_secrets

    got = find_secrets(tables.frame(spark, data))
    assert tables.result(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(brute.secrets(data), key=repr)


def test_guess_cost():
    from riskloom.llm.secrets import guess_cost

    bits = {v: guess_cost(v)[0] for v in ("password", "P@ssw0rd", "qwertyuiop", "aaaaaaaaaaaa", "20240131", "f83kX0qLm2Zt", "dragon1999")}
    assert bits["f83kX0qLm2Zt"] > 45 and all(b < 30 for v, b in bits.items() if v != "f83kX0qLm2Zt")
    assert [k for _, _, k in guess_cost("dragon1999")[1]] == ["word", "date"]
    start, end = guess_cost("")[0], guess_cost("x" * 5000)[0]
    assert start == 0 and end < 5000  # brute force: 23,500


def test_long_repeats_and_walks_are_cheap():
    import math

    from riskloom.llm.secrets import ROWS, guess_cost, guessed_spans

    assert guess_cost("x" * 80)[0] == pytest.approx(math.log2(26) + math.log2(80) + 1)
    assert guess_cost("=" * 4000)[0] == pytest.approx(math.log2(33) + math.log2(4000) + 1)
    for value in ("x" * 80, "*" * 100, "1234567890" * 9, "f83kX0qL"[:3] * 60, ROWS[-1] * 3, "password2024" * 7):
        assert guess_cost(value)[0] < 36 and not guessed_spans(f"secret: {value}", 36.0, 8), value
    # one walk over a whole row, though it is longer than 24
    assert guess_cost(ROWS[-1])[1] == ((0, 26, "walk"),)
    unit = "f83kx0qlm2ztw9"
    brute = guess_cost(unit)[0] - 1  # one segment pays 1, here the repeat
    assert guess_cost(unit * 40)[0] == pytest.approx(brute + math.log2(40) + 1)


def test_maximal_repeats():
    from riskloom.llm.secrets import _repeats

    for text in ("aabaabaab", "xyxyxxyxyx", "abcabcab", "mississippi", "aaaa"):
        every = set()
        for p in range(1, len(text)):
            for a in range(len(text)):
                b = a + p
                while b < len(text) and text[b] == text[b - p]:
                    b += 1
                if b - a >= 2 * p and (a == 0 or text[a - 1] != text[a + p - 1]):
                    every.add((a, b, p))
        least = {(a, b): min(p for x, y, p in every if (x, y) == (a, b)) for a, b, _ in every}
        assert sorted(_repeats(text)) == sorted((a, b, p) for (a, b), p in least.items())


def test_guessed_span_is_added(spark):
    from riskloom.llm.secrets import find_secrets

    text = "pwd: f83kX0q!Lm2Zt and pwd: password"
    row = find_secrets(tables.frame(spark, [(1, text)])).collect()[0]
    assert row["spans"] == "guess:5:18" and row["n_assign"] == 0


def test_tokens(spark, data):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from riskloom.llm.tokens import count_tokens

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    data = [*data, *([(500, "it's <|endoftext|> we'll  \n\n x<|endoftext|>"), (501, "''re 'r 've\u3000 ½ 中文")] if data else [])]
    got = tables.result(count_tokens(tables.frame(spark, data), path), "doc_id", "n_bytes", "n_tokens", "over_limit")
    wanted = []
    for d, t in data:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        wanted.append((d, len((t or "").encode()), n, n > 1024))
    assert got == sorted(wanted, key=repr)


def test_line_dedup(spark, data):
    from riskloom.llm.line_dedup import line_dedup

    got = line_dedup(tables.frame(spark, data))
    assert tables.result(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted(brute.lines(data), key=repr)


def test_quality(spark, data):
    from riskloom.llm.quality import quality

    got = quality(tables.frame(spark, data), least_docs=2)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert tables.result(got, *columns) == sorted(brute.base_quality(data), key=repr)


def test_boilerplate(spark):
    from riskloom.llm.quality import quality

    rows = [(i, "h", f"Shared  line of Text\nown words {i} " + "w " * (i % 5)) for i in range(40)]
    rows += [(100 + i, "h", "shared line of text") for i in range(9)] + [(200, None, "shared line of text\nshared line of text"), (201, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r["doc_id"]: r for r in quality(df, least_docs=5).collect()}
    assert {d: r["boilerplate_words"] for d, r in got.items()} == brute.boilerplate(rows, 5)
    assert not got[100]["kept"]
    text = " ".join(f"a{k}" for k in range(30)) + "\n" + " ".join(f"b{k}" for k in range(30))
    many = spark.createDataFrame([(i, "h", text) for i in range(60)], "doc_id long, source string, text string")
    assert quality(many, least_docs=5).filter("kept").count() == 60  # copies don't make boilerplate


def test_keep_runs(spark):
    from pyspark.sql import functions as F

    from riskloom.llm.line_dedup import apply_keep, keep_runs

    df = spark.createDataFrame([(["a", "b", "c", "d"], [0, 2]), (["a"], [0]), (["a", "b"], [])], "lines array<string>, dropped array<int>")
    kept = df.select(apply_keep(F.col("lines"), keep_runs(F.size("lines"), F.col("dropped")))).collect()
    assert [r[0] for r in kept] == ["b\nd", "", "a\nb"]


PAGES = [(1, "u", "<p>x"), (2, None, "<p>x"), (3, "http://a b\r\nc", None), (4, "", ""), (None, "n", "<p>x"), (6, "u", "é" * 5000), (7, "u", "\r\n\r\n"), (2, "u", "<p>x"), (2, "u", "other")]


@pytest.mark.parametrize("data", [PAGES, []])
def test_warc(spark, data):
    from riskloom.llm.warc import archive_round_trip

    df = spark.createDataFrame(data, "page_id long, url string, html string")
    got = archive_round_trip(df, archive_bytes=500)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert tables.result(got, *columns) == sorted(brute.warc([(p, h) for p, _, h in data]), key=repr)


def test_archive_is_validated():
    from riskloom.llm import warc

    dictionary = warc.train_dictionary([b"<html>"])
    import zstandard

    record = warc.encode_record(5, "u", b"payload", None)
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).compress
    whole = warc.dictionary_frame(dictionary) + pack(record) + pack(warc.encode_record(4, "u", b"payload", 5))
    rows = [warc.decode_record(x) for x in warc.frames(whole)]
    assert rows[0][-1] == b"payload" and rows[0][0] == 5 and rows[1][7] == 5 and rows[1][5] == 7
    for bad in (record[:-1], record.replace(b"payload", b"Payload"), record.replace(b"WARC/1.1", b"WARC/9"), record.replace(b"Length: 7", b"Length: 8")):
        with pytest.raises(ValueError):
            warc.decode_record(bad)
    for bad in (whole[:-3], whole[4:], b"", pack(record)):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.frames(bad))

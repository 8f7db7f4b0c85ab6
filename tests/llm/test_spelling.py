import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import pytest
import tables


def counts(rows, least_length=7, least_count=2, every=31):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", brute.low(text or "")):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= least_count}


def near(words):
    """Unordered pairs, by deleting one letter of each word."""
    out, cuts = set(), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1 :]
            if cut in words:
                out.add(tuple(sorted((w, cut))))
            cuts[i, cut].add(w)
    for same in cuts.values():
        out |= {(a, b) for a in same for b in same if a < b}
    return out


def variants(rows, **given):
    n = counts(rows, **given)
    sides = defaultdict(list)
    for a, b in near(n):
        sides[a].append(b)
        sides[b].append(a)
    form = {}
    for w, others in sides.items():
        best = min(others, key=lambda b: (-n[b], b))
        if n[best] >= 10 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(sides[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_near_pairs(spark):
    """Repeated letters, edits at both ends, words of one length and of neighbouring ones, long words."""
    from riskloom.llm.spelling import near_words

    rng, words = random.Random(2), {"a", "b", "ab", "ba", "aa", "aaa", "aaaa", "é", "éa", "ÿé"}
    for _ in range(300):
        w = "".join(rng.choices("abé", k=rng.randint(1, 9)))
        words.add(w)
        i = rng.randrange(len(w) + 1)
        words.add(w[:i] + rng.choice("abÿ") + w[i:])
    for size in (19, 20, 21, 22, 40):
        w = "".join(rng.choices("ab", k=size))
        words |= {w, w[:5] + "z" + w[5:], w[:-1] + "y", "x" + w[1:], "a" * size, w[: size // 2] + "q" + w[size // 2 + 1 :]}
    frame = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    got = [tuple(r) for r in near_words(frame, 12).collect()]
    assert len(got) == len(set(got)) and set(got) == near(words)


def test_awkward(spark):
    from riskloom.llm.spelling import spelling_variants

    rows = tables.rows(1)
    rng = random.Random(4)
    for i in range(300, 340):
        text = "harvesting " * 30 + "harvestingx harvestin harvesting× Überfall Überfalls ÜBERFALL überfall straßen straßenx strassen "
        rows.append((i if i % 9 else None, text * rng.randint(1, 3) + "HARVESTING" + "x" * rng.choice([0, 1, 2, 300])))
    got = tables.result(spelling_variants(tables.frame(spark, rows), longest=8), *COLUMNS)
    assert got == variants(rows)
    assert any(r[1] for r in got)


def test_chain_of_forms(spark):
    from riskloom.llm.spelling import spelling_variants

    rows = [(1, "abcdefg " * 30000 + "abcdefgh " * 2500), (2, "abcdefghi " * 200 + "abcdefghij " * 20 + "abcdefghijk abcdefghijk")]
    got = tables.result(spelling_variants(tables.frame(spark, rows), every=None), *COLUMNS)
    assert got == variants(rows, every=None)
    assert {r[2] for r in got} == {"abcdefg"}


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")], [(1, "seldomly")]])
def test_no_words(spark, rows):
    from riskloom.llm.spelling import spelling_variants

    assert spelling_variants(tables.frame(spark, rows)).collect() == []


def test_long_text_in_pieces():
    from riskloom.llm.spelling import _pieces

    other = re.compile("[^a-zÀ-ÿ]")
    text = "word " * 50 + "x" * 90 + " " + "yz " * 30
    pieces = list(_pieces(text, other, 16))
    assert "".join(pieces) == text and len(pieces) > 5
    assert sum((re.findall("[a-zÀ-ÿ]+", p) for p in pieces), []) == re.findall("[a-zÀ-ÿ]+", text)


def test_given(spark):
    from riskloom.llm.spelling import spelling_variants

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert tables.result(spelling_variants(docs), *COLUMNS) == variants(rows)

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth long, band long, i int"


def frame(spark, rows):
    """Also columns whose names clash with those inside the operator."""
    return spark.createDataFrame([(*r, "k", 3, 4, 5) for r in rows], SCHEMA)


def rebuilt(rows):
    """Conversations as lists of (role, text), after the exchange of their beginnings."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def brute(convs):
    members, ends = defaultdict(set), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].add(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def below(node):
        todo, seen = [node], []
        while todo:
            seen.append(todo.pop())
            todo += kids[seen[-1]]
        return seen

    out = []
    for node, ms in members.items():
        sub = below(node)
        out.append(
            (
                min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), len(kids[node]), sum(not kids[s] for s in sub),
                sum((len(members[s]) - 1) * len(s[-1][1]) for s in sub if s), hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def awkward(seed=0):
    rng, rows = random.Random(seed), []
    for c in [*range(0, 40), 100, *range(205, 230), 302, -5, -100, -103]:
        for t in range(rng.choice([1, 1, 2, 5, 8, 9])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "é" * 9])))
    rows += [(7, t, "user", rng.choice("xy")) for t in range(20, 90)]  # one long conversation
    rows += [(11, t, "user", "same") for t in range(20, 60)] + [(12, t, "user", "same") for t in range(20, 70)]
    rows += [rows[3], rows[3], (None, 1, "user", "lost"), (40, 0, "us", "era"), (41, 0, "user", "a")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [2, 3, 16])
def test_against_brute_force(spark, height):
    from riskloom.llm.prefix_trie import conversation_trie

    rows = awkward()
    assert got(conversation_trie(frame(spark, rows), height)) == brute(rebuilt(rows))


def test_ids_in_many_rows(spark, monkeypatch):
    """A node at which many conversations end, its ids dealt to several rows."""
    from riskloom.llm import prefix_trie as module

    monkeypatch.setattr(module, "CHUNK", 7)
    rows = [(c, 0, "user", "hello") for c in range(500)]
    assert got(module.conversation_trie(frame(spark, rows))) == brute(rebuilt(rows))


def test_empty(spark):
    from riskloom.llm.prefix_trie import conversation_trie

    assert got(conversation_trie(frame(spark, []))) == []
    assert got(conversation_trie(frame(spark, [(None, 0, "user", "x")]))) == []


def test_plain_sequences(spark):
    """The operator without the exchange of beginnings."""
    from riskloom.llm.prefix_trie import prefix_trie

    turns = spark.createDataFrame([(c, p + 1, w, 1) for c, s in enumerate(["ab", "abc", "abd", "x", ""]) for p, w in enumerate(s)], "conv_id long, pos long, turn_key string, chars long")
    lengths = spark.createDataFrame([(0, 2), (1, 3), (2, 3), (3, 1), (4, 0)], "conv_id long, length long")
    convs = {c: [("", w) for w in s] for c, s in enumerate(["ab", "abc", "abd", "x", ""])}
    assert got(prefix_trie(turns, lengths, 2)) == brute(convs)


def test_given(spark):
    from riskloom.llm.prefix_trie import conversation_trie

    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(conversation_trie(table)) == brute(rebuilt(rows))

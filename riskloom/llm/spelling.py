"""Spelling variants: words that differ by one code point, found by a frontier of states over tries.

A trie is a table of nodes, each named by its prefix, with its children's letters (at most as many as the
alphabet has). A state ``(word, position, node, edits)`` says that the first ``position`` letters of a word,
with ``edits`` changes, lead to ``node``. Its future depends on the letters still to come only, so all
words that share those first letters share one state: ``word`` is their prefix too. A level joins the
frontier with the table twice and goes on where both prefixes have the same next letter; a state at
which both are whole words is a pair of neighbours.

States without an edit are the nodes themselves, so the first edit starts at every node x: another
letter (x + a against x + b) or one more (x against x + b, not followed by b on the shorter side, which
makes the place of the edit unique). Every word is in the trie twice, forwards and backwards, behind a
mark: edits are followed in the far half of either, where few words share a prefix. The ``limit`` of a
state is the length up to which its place counts as the far half.

Words above ``longest`` code points, whose tries would take as many levels, meet by digests of the word
without one letter instead; every such pair is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.arrays import FIRST, SECOND, mix, signed
from riskloom.workspace import written

FORWARD, BACKWARD = ">", "<"
LEAST_LENGTH, LEAST_COUNT, RATIO, EVERY = 7, 2, 10, 31
#: Bytes of distinct words that a task holds before they go out, about.
HELD = 32 << 20


def _pieces(text: str, letter: re.Pattern, size: int = 1 << 20):
    """A text in pieces of about ``size``, none of which ends within a run."""
    begin = 0
    while begin < len(text):
        other = letter.search(text, begin + size)
        end = other.start() if other else len(text)
        yield text[begin:end]
        begin = end


def _occurrences(least_length: int, every: int | None):
    run, other = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}"), re.compile("[^a-zÀ-ÿ]")

    def count(batches):
        held: dict[str, int] = {}
        size = 0

        def out():
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                text, doc_id = text.as_py(), doc_id.as_py()
                # bytes.lower touches A-Z only
                for piece in _pieces((text or "").encode().lower().decode(), other):
                    for word, n in Counter(run.findall(piece)).items():
                        if every:
                            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
                            if h % every == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < least_length:
                                    continue
                        if word in held:
                            held[word] += n
                        else:
                            held[word] = n
                            size += len(word) + 100
                    if size > HELD:
                        yield out()
                        size = 0
        if held:
            yield out()

    return count


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, every: int | None = None) -> DataFrame:
    """``word, n``: maximal runs of letters of whole texts, with A-Z in lower case, and how often they occur.

    Runs of at least ``least_length`` code points that occur ``least_count`` times or more. With ``every``,
    runs whose crc32 of ``<doc_id>:<run>`` (a null id is empty) it divides first lose the letter at that
    crc32 modulo their length. A null text has no words.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = rows.mapInArrow(_occurrences(least_length, every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def trie_table(words: DataFrame) -> DataFrame:
    """``node, depth, is_word, shortest, kids (letter, is_word, shortest)`` of every prefix of ``words (word)``.

    ``shortest`` is the length of the shortest word at or below; ``kids`` holds at most one entry per letter
    of the alphabet.
    """
    size = F.char_length("word")
    prefix = words.select("word", F.explode(F.sequence(F.lit(1), size)).alias("depth")).select(
        F.substring("word", F.lit(1), F.col("depth")).alias("child"), "depth", size.alias("size")
    )
    made = prefix.groupBy("child", "depth").agg(F.min("size").cast("int").alias("shortest"))
    ends = F.col("shortest") == F.col("depth")
    below = made.select(
        F.substring("child", F.lit(1), F.col("depth") - 1).alias("node"),
        F.struct(F.substring("child", F.col("depth"), F.lit(1)).alias("letter"), ends.alias("is_word"), "shortest").alias("kid"),
    )
    kids = below.groupBy("node").agg(F.collect_list("kid").alias("kids"))
    root = words.sparkSession.range(1).select(F.lit("").alias("child"), F.lit(0).alias("depth"), F.lit(-1).alias("shortest"))
    return (
        made.unionByName(root)
        .withColumnRenamed("child", "node")
        .join(kids, "node", "left")
        .select("node", "depth", ends.alias("is_word"), "shortest", "kids")
    )


def _with_limit(nodes: DataFrame) -> DataFrame:
    """Nodes with children, and up to which length of a word a change behind them is in its far half.

    Behind i equal letters that is 2 i + 1, and 2 i for words read backwards; node and word hold a mark too.
    """
    back = F.when(F.col("node").startswith(BACKWARD), 1).otherwise(0)
    return nodes.withColumn("limit", 2 * F.col("depth") - back).filter("shortest <= limit and kids is not null")


def _one_more(nodes: DataFrame) -> DataFrame:
    """States whose node has one letter more than the word, put in behind these nodes.

    The word may not go on with that letter, or the edit would have a later place too.
    """
    fits = F.filter("kids", lambda k: k["shortest"] <= F.col("limit") + 1)
    return nodes.select("node", "is_word", "limit", F.explode(fits).alias("k")).select(
        F.col("node").alias("word"),
        F.col("is_word").alias("word_ends"),
        F.concat("node", "k.letter").alias("node"),
        F.col("k.is_word").alias("node_ends"),
        F.col("k.letter").alias("banned"),
        "limit",
    )


def _another(nodes: DataFrame) -> DataFrame:
    """States that differ in the letter behind these nodes: two children of one node, the smaller first."""
    fits = F.filter("kids", lambda k: k["shortest"] <= F.col("limit"))
    pairs = nodes.select("node", "limit", F.explode(fits).alias("a"), fits.alias("kids"))
    pairs = pairs.select("node", "limit", "a", F.explode(F.filter("kids", lambda k: k["letter"] > F.col("a.letter"))).alias("b"))
    return pairs.select(
        F.concat("node", "a.letter").alias("word"),
        F.col("a.is_word").alias("word_ends"),
        F.concat("node", "b.letter").alias("node"),
        F.col("b.is_word").alias("node_ends"),
        F.lit(None).cast("string").alias("banned"),
        "limit",
    )


def _next(states: DataFrame, trie: DataFrame, at: int) -> DataFrame:
    """The states of position ``at``, one letter on: both sides have it as their next one."""
    kids = trie.filter("kids is not null")
    ours = kids.filter(F.col("depth") == at).select(F.col("node").alias("word"), F.col("kids").alias("ours"))
    theirs = kids.filter(F.col("depth").isin(at, at + 1)).select("node", F.col("kids").alias("theirs"))
    kept = F.filter(
        "ours", lambda k: (k["shortest"] <= F.col("limit")) & (F.col("banned").isNull() | (k["letter"] != F.col("banned")))
    )
    letters = F.col("theirs.letter")
    alive = (
        states.drop("word_ends", "node_ends")
        .join(ours, "word")
        .withColumn("ours", kept)
        .filter(F.size("ours") > 0)
        .join(theirs, "node")
        .withColumn("ours", F.filter("ours", lambda k: F.array_contains(letters, k["letter"])))
    )
    went = alive.select("word", "node", "limit", "theirs", F.explode("ours").alias("k")).withColumn(
        "t", F.element_at("theirs", F.array_position(letters, F.col("k.letter")).cast("int"))
    )
    return went.filter(F.col("t.shortest") <= F.col("limit") + 1).select(
        F.concat("word", "k.letter").alias("word"),
        F.col("k.is_word").alias("word_ends"),
        F.concat("node", "k.letter").alias("node"),
        F.col("t.is_word").alias("node_ends"),
        F.lit(None).cast("string").alias("banned"),
        "limit",
    )


def _frontier(words: DataFrame) -> list[DataFrame]:
    """Pairs ``a, b`` of marked words whose edit lies in the far half, level by level."""
    spark = words.sparkSession
    # sorted by depth, so that a level reads its own rows only
    trie = written(spark, trie_table(words).repartitionByRange("depth", "node").sortWithinPartitions("depth"), "spelling-trie")
    deepest, shortest = trie.filter("depth > 0").agg(F.max("depth"), F.min("shortest")).first()
    states, pairs = None, []
    for at in range(shortest // 2, deepest + 1) if deepest else []:
        level = _one_more(_with_limit(trie.filter(F.col("depth") == at)))
        level = level.unionByName(_another(_with_limit(trie.filter(F.col("depth") == at - 1))))
        if states is not None:
            level = level.unionByName(_next(states, trie, at - 1))
        states = written(spark, level, "spelling-frontier")
        pairs.append(states.filter(F.col("word_ends") & F.col("node_ends")).select(F.col("word").alias("a"), F.col("node").alias("b")))
    return pairs


def _without_one(batches):
    """Per word (``id, size, word``) the hash of the whole (``at`` 0) and without each letter (``at`` from 1)."""
    for batch in batches:
        for name, word in zip(batch.column("id"), batch.column("word")):
            points = np.frombuffer(word.as_py().encode("utf-32-le"), dtype=np.uint32)
            n, lanes = len(points), []
            for lane in (FIRST, SECOND):
                sums = lane.sums(mix(points.astype(np.uint64) + np.uint64(1)))
                rest = (sums[n] - sums[1:]) * lane.inverse[1]
                lanes.append(signed(np.concatenate([sums[n:], sums[:-1] + rest])))
            for i in range(0, n + 1, 1 << 16):
                at = np.arange(i, min(n + 1, i + (1 << 16)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.as_py()] * len(at)), pa.array(np.full(len(at), n)), pa.array(at), *(pa.array(v[at]) for v in lanes)],
                    ["id", "size", "at", "h1", "h2"],
                )


def _long_pairs(words: DataFrame, longest: int) -> DataFrame:
    """Near pairs of which the longer word has more than ``longest`` code points.

    Hashes of a word without one letter find them; the words themselves are compared afterwards.
    """
    long = written(words.sparkSession, words.filter(F.char_length("word") >= longest).select(F.sha2("word", 256).alias("id"), "word"), "long-words")
    less = long.mapInArrow(_without_one, "id string, size long, at long, h1 long, h2 long")
    less = written(words.sparkSession, less, "long-hashes")
    cut = less.filter((F.col("at") > 0) & (F.col("size") > longest))
    whole = less.filter("at = 0").select(F.col("id").alias("a"), "h1", "h2")
    inserted = cut.withColumnRenamed("id", "b").join(whole, ["h1", "h2"]).groupBy("a", "b").agg(F.min("at").alias("at"))
    # equal but for the letter at one place: at most as many as the alphabet has letters
    left, right = (cut.select(F.col("id").alias(n), "at", "h1", "h2", "size") for n in "ab")
    replaced = left.join(right, ["h1", "h2", "at", "size"]).filter("a < b").groupBy("a", "b").agg(F.min("at").alias("at"))
    named = [long.select(F.col("id").alias(n), F.col("word").alias(f"word_{n}")) for n in "ab"]

    def spared(word):  # the word without its letter ``at``
        return F.concat(F.expr(f"substring({word}, 1, int(at) - 1)"), F.expr(f"substring({word}, int(at) + 1)"))

    found = inserted.join(named[0], "a").join(named[1], "b").filter(F.col("word_a") == spared("word_b"))
    other = replaced.join(named[0], "a").join(named[1], "b").filter(spared("word_a") == spared("word_b"))
    return found.unionByName(other).select(F.col("word_a").alias("a"), F.col("word_b").alias("b"))


def near_words(words: DataFrame, longest: int = 64) -> DataFrame:
    """``a, b``: every unordered pair of ``words (word)`` that differ by one inserted, deleted or replaced code point."""
    short = words.select("word").filter(F.char_length("word") <= longest)
    both = F.array(F.concat(F.lit(FORWARD), "word"), F.concat(F.lit(BACKWARD), F.reverse("word")))  # by code points
    out = _long_pairs(words.select("word"), longest)
    for p in _frontier(short.select(F.explode(both).alias("word"))):
        back = F.col("a").startswith(BACKWARD)
        plain = [F.expr(f"substring({c}, 2)").alias(c) for c in "ab"]
        turned = [F.when(back, F.reverse(x)).otherwise(x).alias(c) for c, x in zip("ab", plain)]
        out = out.unionByName(p.select(*turned))
    return out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def follow(words: DataFrame) -> DataFrame:
    """``word, root`` from ``words (word, form)``: forms followed to the last, twice as far in each round."""
    spark = words.sparkSession
    ways = written(spark, words.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways, before = written(spark, ways.join(on, "root").select("word", F.col("next").alias("root")), "roots"), ways
        moved = ways.join(before.withColumnRenamed("root", "was"), "word").filter("root <> was")
        if moved.isEmpty():
            return ways


def spelling_variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    every: int | None = EVERY,
    longest: int = 64,
) -> DataFrame:
    """One row per word of ``docs``: ``word, form, root, n, n_near, form_n``.

    ``n_near`` counts the words that differ by one code point. The most frequent of them (ties: the first
    in code-point order) is the word's form if it occurs at least ``ratio`` times as often; ``root`` is
    where the forms lead. Without words there are no rows.
    """
    spark = docs.sparkSession
    words = written(spark, word_counts(docs, least_length, least_count, every), "words")
    pairs = near_words(words, longest)
    both = written(spark, pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "near-words")
    counted = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("near_n")), "b")
    best = counted.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("b").alias("form"))).alias("best")
    )
    frequent = -F.col("best.minus") >= ratio * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("best.form")).alias("form"),
        F.when(frequent, -F.col("best.minus")).alias("form_n"),
    )
    formed = written(spark, formed, "forms")
    return formed.join(follow(formed), "word").select("word", "form", "root", "n", "n_near", "form_n")

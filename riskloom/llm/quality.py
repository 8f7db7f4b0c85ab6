"""Quality rules: per-document counts, and lines that too many documents of a host share.

Method (cross-document line frequency): every line is normalised (its words, A-Z lower-cased, joined
by one space) and hashed; for each host the distinct texts that hold a line are counted; lines above
the limit are taken as boilerplate, and a document is rejected when they make up nearly all of it.
Copies of one text count once, so a document isn't boilerplate for being copied.

Edge cases: a null text is empty (no words: it fails the base rule); a null source is the host '';
a null id passes through; repeated rows get equal rows; an empty table gives no rows; further columns
are left out of the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.arrays import FIRST, LOWER, covered, mix, text_slices, words
from riskloom.llm.frames import keyed, named
from riskloom.workspace import written

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW = 8
COUNTS = "row_key long, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
LINES = "row_key long, text_key long, host string, line long, line_words long"


def _line_starts(data, bounds):
    """Where lines begin (a text begins one too)."""
    breaks = np.flatnonzero(data == 0x0A) + 1
    return np.unique(np.concatenate([bounds[:-1], breaks[breaks < len(data)]]))


def _total(flags, bounds):
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _own(hashes, owner):
    """Hashes that also tell the owner apart."""
    return mix(hashes + mix(owner.astype(np.uint64) + np.uint64(1)))


def _counts(data, bounds):
    n = len(bounds) - 1
    starts, ends, doc = words(data, bounds)
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    chars = _total(inside & ((data & 0xC0) != 0x80), bounds)
    symbols = _total(SYMBOLS[data], bounds)
    # lines with a word, and how many of them are distinct in their text
    begin = _line_starts(data, bounds)
    begin = begin[begin < len(data)]
    line_doc = np.searchsorted(bounds, begin, side="right") - 1
    stop = np.minimum(np.append(begin[1:], len(data)), bounds[line_doc + 1])
    stop = np.where((stop > begin) & (data[stop - 1] == 0x0A), stop - 1, stop)
    filled = np.searchsorted(starts, stop) > np.searchsorted(starts, begin)
    begin, stop, line_doc = begin[filled], stop[filled], line_doc[filled]
    _, once = np.unique(_own(FIRST.words(data, begin, stop), line_doc), return_index=True)
    dup_lines = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[once], minlength=n)
    # words in windows that their text holds twice
    hit = np.zeros(len(starts), dtype=bool)
    if len(starts) >= WINDOW:
        sums = FIRST.sums(FIRST.words(data, starts, ends))
        at = np.flatnonzero(doc[: len(doc) - WINDOW + 1] == doc[WINDOW - 1 :])
        _, group, size = np.unique(_own(FIRST.span(sums, at, at + WINDOW), doc[at]), return_inverse=True, return_counts=True)
        again = at[size[group] > 1]
        hit = covered(len(starts), again, WINDOW)
    return [np.bincount(doc, minlength=n), chars, symbols, dup_lines, np.bincount(doc[hit], minlength=n)]


def _count_batches(batches):
    for batch in batches:
        for first, last, data, bounds in text_slices(batch.column("text")):
            rows = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [rows.column("row_key"), rows.column("text_key"), *(pa.array(x.astype(np.int64)) for x in _counts(data, bounds))],
                names=["row_key", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
            )


def _line_batches(batches):
    for batch in batches:
        for first, last, data, bounds in text_slices(batch.column("text")):
            rows = batch.slice(first, last - first)
            starts, ends, doc = words(data, bounds)
            if not len(starts):
                continue
            begin = _line_starts(data, bounds)
            line = np.searchsorted(begin, starts, side="right") - 1
            low = np.flatnonzero(np.diff(line, prepend=-1))  # first words of lines
            high = np.append(low[1:], len(starts))
            sums = FIRST.sums(FIRST.words(LOWER[data], starts, ends))
            hashes, owner = FIRST.span(sums, low, high), doc[low]
            _, first_at, group = np.unique(_own(hashes, owner), return_index=True, return_inverse=True)
            size = np.bincount(group, weights=high - low).astype(np.int64)
            of = pa.array(owner[first_at])
            yield pa.RecordBatch.from_arrays(
                [rows.column("row_key").take(of), rows.column("text_key").take(of), rows.column("host").take(of), pa.array(hashes[first_at].view(np.int64)), pa.array(size)],
                names=["row_key", "text_key", "host", "line", "line_words"],
            )


def quality(docs: DataFrame, host: str = "source", least_docs: int = 20, host_share: float = 0.1, depleted: float = 0.8) -> DataFrame:
    """One row per document: its counts, ``base_failed``, ``boilerplate_words`` and the verdict ``kept``.

    A line is boilerplate of a host when more than ``least_docs`` and more than ``host_share`` of the
    host's distinct texts hold it. A document is depleted when more than ``depleted`` of its words
    stand in such lines.
    """
    texts = keyed(docs, F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"))
    counts = texts.select("row_key", "text_key", "text").mapInArrow(_count_batches, COUNTS)
    lines = texts.mapInArrow(_line_batches, LINES)
    sizes = texts.select("host", "text_key").distinct().groupBy("host").agg(F.count("*").alias("host_texts"))
    common = (
        lines.select("host", "line", "text_key")
        .distinct()
        .groupBy("host", "line")
        .agg(F.count("*").alias("holders"))
        .filter(F.col("holders") > least_docs)
        .join(sizes, "host")
        .filter(F.col("holders") > F.col("host_texts") * host_share)
        .select("host", "line")
    )
    # written, so that a hot line can be split in the join
    common = written(docs.sparkSession, common, "host-lines")
    # copies of a row hold the same lines: max, not sum, over repeated rows of one key
    lost = (
        lines.join(common, ["host", "line"])
        .groupBy("row_key", "text_key", "host", "line")
        .agg(F.max("line_words").alias("line_words"))
        .groupBy("row_key", "text_key", "host")
        .agg(F.sum("line_words").alias("boilerplate_words"))
        .groupBy("row_key", "text_key")
        .agg(F.max("boilerplate_words").alias("boilerplate_words"))
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return named(
        counts.join(lost, ["row_key", "text_key"], "left")
        .fillna(0, ["boilerplate_words"])
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("boilerplate_words") <= depleted * F.col("n_words")))
    )

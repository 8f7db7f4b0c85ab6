"""Benchmark decontamination by winnowing.

Method (winnowing): of every window of ``size`` words only the least of its k-gram hashes is a
fingerprint, for documents and benchmark alike, so any shared span of ``size`` words shares one.
Where a document's fingerprint is one of the benchmark's, the hit is extended: the windows around it
are compared, by 128 bits, with the benchmark's windows. An item of fewer words is one window of its
own length. The benchmark's windows go to the executors in slices of at most ``slice_windows``, one
after the other, so what is broadcast is bounded however large the benchmark is.

Edge cases: a null or empty text has no words and is clean; an item with a null id contaminates, but
is neither counted nor named; repeated rows get equal rows; an empty benchmark leaves all clean; an
empty documents table gives no rows; further columns are left out of the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.arrays import FIRST, LOWER, SECOND, anchors, text_slices, words
from riskloom.llm.frames import keyed, named
from riskloom.workspace import written

SIZE, GRAM = 13, 8
GAPS = np.zeros(256, dtype=bool)
GAPS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True  # after A-Z became a-z
WINDOWS = "item_id string, size int, high long, low long, finger long"
HITS = "row_key long, text_key long, start int, size int, high long, low long"


def _windows(batches):
    """All windows of the benchmark, and the fingerprint of each."""
    for batch in batches:
        for first, last, data, bounds in text_slices(batch.column("text")):
            ids = batch.column("item_id").slice(first, last - first)
            data = LOWER[data]
            starts, ends, item = words(data, bounds, GAPS)
            count = np.bincount(item, minlength=last - first)
            one, two = (lane.sums(lane.words(data, starts, ends)) for lane in (FIRST, SECOND))
            at = np.flatnonzero((item[: max(0, len(item) - SIZE + 1)] == item[SIZE - 1 :]))
            short = np.flatnonzero((count > 0) & (count < SIZE))
            begin = np.searchsorted(item, short)
            fingers = np.zeros(len(at), np.uint64)
            if len(at):
                grams = FIRST.span(one, np.arange(len(starts) - GRAM + 1), np.arange(GRAM, len(starts) + 1))
                every = np.lib.stride_tricks.sliding_window_view(grams | np.uint64(1), SIZE - GRAM + 1)[at]
                fingers = grams[at + every.argmin(axis=1)]
            low, high = np.concatenate([at, begin]), np.concatenate([at + SIZE, begin + count[short]])
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(item[low])),
                    pa.array((high - low).astype(np.int32)),
                    pa.array(FIRST.span(one, low, high).view(np.int64)),
                    pa.array(SECOND.span(two, low, high).view(np.int64)),
                    pa.array(np.concatenate([fingers, np.zeros(len(begin), np.uint64)]).view(np.int64)),
                ],
                names=["item_id", "size", "high", "low", "finger"],
            )


class Members:
    """A sorted set of hashes behind a table of their last 16 bits."""

    def __init__(self, values):
        self.values = np.unique(values)
        self.last = np.zeros(1 << 16, dtype=bool)
        self.last[(self.values & np.uint64(0xFFFF)).astype(np.intp)] = True

    def find(self, hashes):
        """Which positions of ``hashes`` hold a member."""
        maybe = np.flatnonzero(self.last[(hashes & np.uint64(0xFFFF)).astype(np.intp)])
        if not len(maybe) or not len(self.values):
            return maybe[:0]
        at = np.minimum(np.searchsorted(self.values, hashes[maybe]), len(self.values) - 1)
        return maybe[self.values[at] == hashes[maybe]]


def _hits(shared):
    def run(batches):
        size, high, low, finger = shared.value
        fingers = Members(finger[size == SIZE])
        known = {int(s): Members(mixed(high[size == s], low[size == s])) for s in np.unique(size)}
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column("text")):
                rows = batch.slice(first, last - first)
                data = LOWER[data]
                starts, ends, doc = words(data, bounds, GAPS)
                one = FIRST.sums(FIRST.words(data, starts, ends))
                two, found = None, []
                for span, members in known.items():
                    at = np.arange(max(0, len(starts) - span + 1))
                    if span == SIZE:
                        grams = FIRST.span(one, np.arange(max(0, len(starts) - GRAM + 1)), np.arange(GRAM, max(GRAM, len(starts) + 1)))
                        spots = anchors(grams, doc, SIZE - GRAM + 1, GRAM)
                        spots = spots[fingers.find(grams[spots])]
                        at = np.unique(spots[:, None] - np.arange(SIZE - GRAM + 1))
                        at = at[(at >= 0) & (at <= len(starts) - SIZE)]
                    at = at[doc[at] == doc[at + span - 1]]
                    if span < SIZE and len(at):  # most positions fail the first 64 bits
                        heads = Members(high[size == span])
                        at = at[heads.find(FIRST.span(one, at, at + span))]
                    if not len(at):
                        continue
                    two = SECOND.sums(SECOND.words(data, starts, ends)) if two is None else two
                    a, b = FIRST.span(one, at, at + span), SECOND.span(two, at, at + span)
                    good = members.find(mixed(a, b))
                    found.append((at[good], np.full(len(good), span), a[good], b[good]))
                if not found:
                    continue
                at, spans, a, b = (np.concatenate(x) for x in zip(*found))
                of = doc[at]
                begin = np.searchsorted(doc, of)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("row_key").take(pa.array(of)), rows.column("text_key").take(pa.array(of)),
                        pa.array((at - begin).astype(np.int32)), pa.array(spans.astype(np.int32)),
                        pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                    ],
                    names=["row_key", "text_key", "start", "size", "high", "low"],
                )

    return run


def mixed(high, low):
    """One number of two hashes; a pair that passes is compared in full by the join on items."""
    return high ^ (low << np.uint64(1) | low >> np.uint64(63))


def _sizes(batches):
    for batch in batches:
        for first, last, data, bounds in text_slices(batch.column("text")):
            rows = batch.slice(first, last - first)
            _, _, doc = words(LOWER[data], bounds, GAPS)
            n = np.bincount(doc, minlength=last - first).astype(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column("row_key"), rows.column("text_key"), pa.array(n)], names=["row_key", "text_key", "n_words"])


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    return items.mapInArrow(_windows, WINDOWS)


def window_hits(texts: DataFrame, windows: DataFrame, slice_windows: int = 1_000_000) -> DataFrame:
    """``row_key, text_key, start, size, item_id`` of each window of ``windows`` in ``texts``."""
    spark = texts.sparkSession
    distinct = windows.select("size", "high", "low", "finger").distinct()
    slices = max(1, -(-distinct.count() // slice_windows))
    found = []
    for i in range(slices):
        part = distinct.filter(F.pmod(F.xxhash64("high", "low"), F.lit(slices)) == i).toArrow()
        arrays = [part.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("size", "high", "low", "finger")]
        shared = spark.sparkContext.broadcast((arrays[0], *(x.view(np.uint64) for x in arrays[1:])))
        found.append(written(spark, texts.mapInArrow(_hits(shared), HITS), "window-hits"))
        shared.unpersist()
    hits = found[0]
    for more in found[1:]:
        hits = hits.union(more)
    owners = windows.select("item_id", "size", "high", "low").distinct()
    return hits.join(owners, ["size", "high", "low"]).select("row_key", "text_key", "start", "size", "item_id")


def contamination(docs: DataFrame, benchmark: DataFrame, share: int = 20, slice_windows: int = 1_000_000) -> DataFrame:
    """One row per document: words, words hit, the items that hit, and whether 1/``share`` of it is hit."""
    texts = keyed(docs)
    windows = written(docs.sparkSession, benchmark_windows(benchmark), "benchmark-windows")
    hits = window_hits(texts, windows, slice_windows).groupBy("row_key", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("start", "size"))).alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    # spans are in order of their starts: each adds what reaches beyond the ends so far
    total = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["start"] + s["size"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(acc["end"], s["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    found = hits.select("row_key", "text_key", total.cast("long").alias("n_hit"), "items")
    sizes = texts.mapInArrow(_sizes, "row_key long, text_key long, n_words long")
    none = F.array().cast("array<string>")
    return named(
        sizes.join(found, ["row_key", "text_key"], "left")
        .select(
            "row_key",
            "text_key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", none).alias("items"),
        )
        .select(
            "row_key",
            "text_key",
            "n_words",
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
            ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
            "items",
        )
    )

"""Substring dedup over words by level-wise doubling.

Method: windows that are repeated at one length alone are extended to twice that length, until the
wanted length (50 words) is reached or no candidate survives.

* 13 words: from every 50-word window its least 13-word window is taken (a window's copies take the
  same one), so each long window stays represented by about one position in twenty. Those that occur
  in one text only are dropped.
* 25 words: what survives is extended to the right and, for the long windows that end too soon for
  that, to the left; again only what occurs in two texts stays.
* 50 words: all long windows around the survivors are compared by 128 bits. The smallest doc_id that
  holds a window keeps it; all other documents lose its words.

Whole copies of a text are told by one grouping of text hashes and stay out of the levels.

Edge cases: a null text has no words; a text of fewer words than the window loses nothing; a null id
sorts after every other; windows repeated only within one document stay; repeated rows get equal
rows; an empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.arrays import FIRST, SECOND, anchors, covered, text_slices, words
from riskloom.llm.frames import keyed, named
from riskloom.workspace import written

KEYS = ["row_key", "text_key"]
SEEDS = "row_key long, text_key long, at int, seed long, left long, right long"
WINDOWS = "row_key long, text_key long, start int, high long, low long"
RESULT = "row_key long, text_key long, n_words long, n_removed long, kept_sha256 string, removed binary"


def levels(window: int) -> tuple[int, int]:
    """Lengths of the first two levels: halves, rounded up."""
    half = -(-window // 2)
    return -(-half // 2), half


def _seeds(window):
    quarter, half = levels(window)

    def run(batches):
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column("text")):
                rows = batch.slice(first, last - first)
                starts, ends, doc = words(data, bounds)
                n = len(starts)
                if n < window:
                    continue
                sums = FIRST.sums(FIRST.words(data, starts, ends))
                at = np.arange(n - quarter + 1)
                hashes = FIRST.span(sums, at, at + quarter)
                at = anchors(hashes, doc, window - quarter + 1, quarter)
                begin = np.searchsorted(doc, doc[at])
                end = np.searchsorted(doc, doc[at], side="right")
                low, high = at + quarter - half, at + half
                left = np.where(low >= begin, FIRST.span(sums, np.maximum(low, 0), at + quarter), np.uint64(0))
                right = np.where(high <= end, FIRST.span(sums, at, np.minimum(high, n)), np.uint64(0))
                of = pa.array(doc[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("row_key").take(of), rows.column("text_key").take(of), pa.array((at - begin).astype(np.int32)),
                        *(pa.array(x.view(np.int64)) for x in (hashes[at], left, right)),
                    ],
                    names=["row_key", "text_key", "at", "seed", "left", "right"],
                )

    return run


def _long_windows(window):
    quarter, half = levels(window)

    def run(batches):
        for batch in batches:
            spots = batch.column("spots")
            for first, last, data, bounds in text_slices(batch.column("text")):
                rows, own = batch.slice(first, last - first), spots.slice(first, last - first)
                starts, ends, doc = words(data, bounds)
                flat = own.flatten()
                at = flat.field("at").to_numpy(zero_copy_only=False).astype(np.int64)
                side = flat.field("side").to_numpy(zero_copy_only=False)
                of = np.repeat(np.arange(last - first), own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                base = np.searchsorted(doc, np.arange(last - first))
                size = np.bincount(doc, minlength=last - first)
                # windows that hold the seed and its extension
                least = np.maximum(0, np.where(side == 1, at - (window - half), at - (window - quarter)))
                most = np.minimum(size[of] - window, np.where(side == 1, at, at - (window - half) - 1))
                good = most >= least
                mark = np.zeros(len(starts) + 1, np.int64)
                np.add.at(mark, base[of[good]] + least[good], 1)
                np.add.at(mark, base[of[good]] + most[good] + 1, -1)
                begin = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
                if not len(begin):
                    continue
                one, two = (lane.sums(lane.words(data, starts, ends)) for lane in (FIRST, SECOND))
                owner = doc[begin]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("row_key").take(pa.array(owner)), rows.column("text_key").take(pa.array(owner)),
                        pa.array((begin - base[owner]).astype(np.int32)),
                        pa.array(FIRST.span(one, begin, begin + window).view(np.int64)),
                        pa.array(SECOND.span(two, begin, begin + window).view(np.int64)),
                    ],
                    names=["row_key", "text_key", "start", "high", "low"],
                )

    return run


def _kept(window):
    def run(batches):
        for batch in batches:
            out = []
            column = batch.column("text")
            for first, last, data, bounds in text_slices(column):
                starts, ends, doc = words(data, bounds)
                whole = batch.column("whole").slice(first, last - first).to_pylist()
                removed = batch.column("removed").slice(first, last - first).to_pylist()
                edge = np.searchsorted(doc, np.arange(last - first + 1))
                raw = data.tobytes()
                for i in range(last - first):
                    low, high = edge[i], edge[i + 1]
                    n = int(high - low)
                    if whole[i] and n >= window:
                        hit = np.ones(n, dtype=bool)
                    elif removed[i]:
                        hit = covered(n, np.asarray(removed[i], dtype=np.int64), window)
                    else:
                        hit = np.zeros(n, dtype=bool)
                    kept = np.flatnonzero(~hit) + low
                    text = b" ".join([raw[a:b] for a, b in zip(starts[kept].tolist(), ends[kept].tolist())])
                    out.append((n, int(hit.sum()), hashlib.sha256(text).hexdigest(), np.packbits(hit).tobytes() if hit.any() else None))
            columns = list(zip(*out)) or [()] * 4
            types = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("text_key"), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=[x.split()[0] for x in RESULT.split(", ")],
            )

    return run


def in_two_texts(rows: DataFrame, *hashes: str) -> DataFrame:
    """The hashes that occur in two texts or more."""
    spans = rows.groupBy(*hashes).agg(F.min("text_key").alias("a"), F.max("text_key").alias("b"))
    return spans.filter("a < b").select(*hashes)


def copies(texts: DataFrame) -> DataFrame:
    """Rows whose whole text also has a smaller id, by 128 bits of it."""
    rows = texts.select(*KEYS, F.md5(F.col("text").cast("binary")).alias("digest"))
    first = rows.groupBy("digest").agg(F.min("row_key").alias("owner"), F.max("row_key").alias("last")).filter("owner < last")
    first = written(texts.sparkSession, first.select("digest", "owner"), "copied-texts")
    return rows.join(first, "digest").filter("row_key > owner").select(*KEYS).distinct()


def repeated_windows(texts: DataFrame, window: int = 50) -> DataFrame:
    """``row_key, text_key, removed (starts of windows a smaller id holds too), whole (a copy of a smaller id)``."""
    spark = texts.sparkSession
    whole = written(spark, copies(texts), "copies")
    seeds = texts.mapInArrow(_seeds(window), SEEDS)
    live = written(spark, in_two_texts(seeds, "seed"), "live-quarters")
    spots = written(spark, seeds.join(live, "seed").drop("seed"), "quarters")
    sides = spots.select(
        *KEYS, "at", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("half")), F.struct(F.lit(1).alias("side"), F.col("right").alias("half")))).alias("x")
    ).select(*KEYS, "at", "x.side", "x.half").filter("half != 0")
    live = written(spark, in_two_texts(sides, "half"), "live-halves")
    spots = (
        sides.join(live, "half")
        .groupBy(*KEYS)
        .agg(F.collect_set(F.struct("at", "side")).alias("spots"))
        .join(whole, KEYS, "left_anti")
    )
    candidates = texts.join(spots, KEYS).select(*KEYS, "text", "spots").mapInArrow(_long_windows(window), WINDOWS)
    candidates = written(spark, candidates, "long-windows")
    owners = candidates.groupBy("high", "low").agg(F.min("row_key").alias("owner"), F.max("row_key").alias("last"))
    owners = written(spark, owners.filter("owner < last").select("high", "low", "owner"), "window-owners")
    lost = candidates.join(owners, ["high", "low"]).filter("row_key > owner")
    lost = lost.groupBy(*KEYS).agg(F.collect_set("start").alias("removed"))
    return lost.join(whole.withColumn("whole", F.lit(True)), KEYS, "full")


def substring_dedup(docs: DataFrame, window: int = 50) -> DataFrame:
    """One row per document: words, words removed, a digest of the rest, ``removed`` as a bitmap of words."""
    texts = keyed(docs)
    marked = texts.join(repeated_windows(texts, window), KEYS, "left").select(*KEYS, "text", "removed", "whole")
    return named(marked.mapInArrow(_kept(window), RESULT))

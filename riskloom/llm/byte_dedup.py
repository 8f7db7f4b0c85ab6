"""Substring dedup over UTF-8 bytes with sharded suffix arrays.

Method (induced sorting): which suffixes can matter is found first. Of every string of ``length``
bytes the least hash of its k-grams (the seed) stands for it; equal strings have equal seeds at equal
places, so only strings whose seed occurs twice go on. They are cut into segments, one per seed, and
dealt to shards by seed: all strings that are equal are in one shard. Equal segments are told by one
grouping; for the distinct ones each shard builds a suffix array by induced sorting (suffixes
classified, leftmost-smaller substrings sorted, the rest induced) and the common prefixes in text
order. Neighbours that share ``length`` bytes form groups of equal strings, of which the first stays.

A seed may have any number of distinct segments (a passage in many documents, with other neighbours
in each). Where they exceed ``shard_bytes`` they are narrowed: strings at nearby offsets from the seed
form cells, and the bytes that all strings of a cell share become part of the shard's key. Each level
has narrower cells; equal pieces are told by grouping again, and what is alone in its shard is done.

Edge cases: a null text is empty; a text shorter than ``length`` loses nothing; a null id sorts after
every other; repeated rows get equal rows and don't remove each other; an empty table gives no rows;
further columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.arrays import FIRST, SECOND, anchors, mix, text_slices
from riskloom.llm.frames import keyed, named, stored
from riskloom.llm.repeats import KEYS, copies
from riskloom.llm.suffixes import common_prefixes, suffix_array

GRAM_STEPS, SLICE = 5, 1 << 18
GRAM = 1 << GRAM_STEPS
SEEDS = "row_key long, text_key long, seed long, n int"
SEGMENTS = "row_key long, text_key long, shard long, lead long, start long, strings long, high long, low long, content binary"
LOST = "row_key long, text_key long, start long, strings long"
#: Cells of the levels of narrowing, in strings; a cell of one string holds nothing but copies.
CELLS = (18, 5, 1)
RESULT = "row_key long, text_key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed string"


def _grams(data):
    """Hashes of all k-grams."""
    out, power = FIRST.bytes[data], FIRST.base
    for step in range(GRAM_STEPS):
        size = 1 << step
        out = out[:-size] * np.uint64(power) + out[size:]
        power = power * power & (1 << 64) - 1
    return mix(out)


def _own(seeds, doc):
    return mix(seeds ^ mix(doc.astype(np.uint64) + np.uint64(1)))


def _seeds(length):
    def run(batches):
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column("text"), SLICE):
                if len(data) < length:
                    continue
                rows = batch.slice(first, last - first)
                owner = np.repeat(np.arange(last - first, dtype=np.int32), np.diff(bounds))
                grams = _grams(data)
                at = anchors(grams, owner, length - GRAM + 1, GRAM)
                seeds, doc = grams[at], owner[at]
                _, once, count = np.unique(_own(seeds, doc), return_index=True, return_counts=True)
                of = pa.array(doc[once])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("row_key").take(of), rows.column("text_key").take(of), pa.array(seeds[once].view(np.int64)), pa.array(np.minimum(count, 2).astype(np.int32))],
                    names=["row_key", "text_key", "seed", "n"],
                )

    return run


def least_places(values, width):
    """Where the (leftmost) least of each ``width`` consecutive values is."""
    at, size = np.arange(len(values)), 1
    if len(values) < width:
        return at[:0]

    def better(a, b):
        return np.where(values[b] < values[a], b, a)

    while size * 2 <= width:
        at, size = better(at[:-size], at[size:]), size * 2
    rest = width - size
    return better(at[: len(at) - rest], at[rest:]) if rest else at


def _segments(length):
    def run(batches):
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column("text"), SLICE):
                n = len(data) - length + 1
                if n <= 0:
                    continue
                rows = batch.slice(first, last - first)
                lists = rows.column("seeds")
                wanted = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                wanted = np.unique(_own(wanted, np.repeat(np.arange(last - first), lists.value_lengths().to_numpy(zero_copy_only=False))))
                owner = np.repeat(np.arange(last - first, dtype=np.int32), np.diff(bounds))
                grams = _grams(data)
                places = least_places(grams | np.uint64(1), length - GRAM + 1)[:n]
                whole = owner[:n] == owner[length - 1 :]
                spots = np.unique(places[whole])
                live = np.zeros(len(grams), dtype=bool)
                live[spots[np.isin(_own(grams[spots], owner[spots]), wanted)]] = True
                good = whole & live[places]
                head = good.copy()
                head[1:] &= ~(good[:-1] & (places[1:] == places[:-1]))
                starts = np.flatnonzero(head)
                if not len(starts):
                    continue
                # a segment ends where its seed does
                counts = np.add.reduceat(good.astype(np.int64), starts)
                ends = starts + counts + length - 1
                seed, doc = grams[places[starts]], owner[starts]
                yield _pieces(rows, data, doc, starts, counts, ends, seed, places[starts] - starts, starts - bounds[doc])

    return run


def _pieces(rows, data, of, begin, counts, end, shard, lead, start):
    """A batch of ``SEGMENTS``: bytes begin..end of ``data``, with a digest of 128 bits."""
    one, two = (lane.words(data, begin, end) for lane in (FIRST, SECOND))
    raw, of = data.tobytes(), pa.array(of)
    return pa.RecordBatch.from_arrays(
        [
            rows.column("row_key").take(of), rows.column("text_key").take(of), pa.array(shard.view(np.int64)), pa.array(lead), pa.array(start),
            pa.array(counts), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
            pa.array([raw[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()),
        ],
        names=[x.split()[0] for x in SEGMENTS.split(", ")],
    )


def _cells(length, width):
    """Pieces of segments, one for each cell of ``width`` offsets from the seed; a new shard for each.

    All strings of a cell hold the bytes from the cell's last offset to the end of its first string.
    """
    reach = length - GRAM  # offsets go from -reach to 0

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column("content").to_pylist()
            data = np.frombuffer(b"".join(parts), dtype=np.uint8)
            begins = np.concatenate([[0], np.cumsum([len(x) for x in parts])[:-1]])
            lead, start, strings = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lead", "start", "strings"))
            shard = batch.column("shard").to_numpy(zero_copy_only=False).view(np.uint64)
            low = (reach - lead) // width
            count = (reach - lead + strings - 1) // width - low + 1
            of = np.repeat(np.arange(len(parts)), count)
            cell = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            first = np.maximum(cell * width, reach - lead[of]) - (reach - lead[of])  # strings of the segment
            last = np.minimum(cell * width + width - 1, reach - lead[of] + strings[of] - 1) - (reach - lead[of])
            begin, end = begins[of] + first, begins[of] + last + length
            # bytes that all strings of the cell share, from the segment's begin
            shared = begins[of] + lead[of] - reach
            key = FIRST.words(data, shared + np.minimum(cell * width + width - 1, reach), shared + cell * width + length)
            key = mix(key ^ mix(shard[of] + mix(cell.astype(np.uint64) + np.uint64(width * 1000))))
            yield _pieces(batch, data, of, begin, last - first + 1, end, key, lead[of] - first, start[of] + first)

    return run


def settle(parts, row, start, length):
    """``(segment, offset)`` of the strings of ``parts`` that have an equal one earlier, by a suffix array.

    ``parts`` are segments; ``row`` and ``start`` tell where each stands.
    """
    sizes = np.array([len(p) for p in parts])
    text = np.frombuffer(b"\xff".join(parts) + b"\xff", dtype=np.uint8)  # 0xff is in no UTF-8 text
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    array = suffix_array(text)
    same = common_prefixes(text, array)[array] >= length
    group = np.cumsum(~same)  # neighbours that share enough are of one group
    shared = same | np.append(same[1:], False)  # alone in its group a string is the first
    array, group = array[shared], group[shared]
    segment = np.repeat(np.arange(len(parts)), sizes + 1)[array]
    offset = array - begins[segment]
    whole = offset + length <= sizes[segment]
    segment, offset, group = segment[whole], offset[whole], group[whole]
    if not len(group):
        return segment, offset
    # the first of each group: its least row, and there the least place
    head = np.flatnonzero(np.diff(group, prepend=-1))
    size = np.diff(np.append(head, len(group)))
    whose, place = row[segment], start[segment] + offset
    first = whose == np.repeat(np.minimum.reduceat(whose, head), size)
    place_there = np.where(first, place, np.iinfo(np.int64).max)
    first &= place == np.repeat(np.minimum.reduceat(place_there, head), size)
    return segment[~first], offset[~first]


def _shards(length, chunk_bytes):
    def solve(rows):
        _, row, text, start, parts = (list(c) for c in zip(*rows))
        row, text, start = np.array(row), np.array(text), np.array(start)
        segment, offset = settle(parts, row, start, length)
        order = np.lexsort((offset, segment))
        segment, offset = segment[order], offset[order]
        head = np.ones(len(segment), dtype=bool)
        head[1:] = (segment[1:] != segment[:-1]) | (offset[1:] != offset[:-1] + 1)
        head = np.flatnonzero(head)
        size = np.diff(np.append(head, len(segment)))
        whose = segment[head]
        return pa.RecordBatch.from_arrays(
            [pa.array(row[whose]), pa.array(text[whose]), pa.array(start[whose] + offset[head]), pa.array(size)],
            names=[x.split()[0] for x in LOST.split(", ")],
        )

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for new in zip(*(batch.column(c).to_pylist() for c in ("shard", "row_key", "text_key", "start", "content"))):
                if size >= chunk_bytes and new[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(new)
                size += len(new[-1])
        if rows:
            yield solve(rows)

    return run


def _kept(length):
    def run(batches):
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("text", "whole", "removed"))
            for text, whole, removed in zip(*columns):
                raw = text.encode()
                if whole and len(raw) >= length:
                    spans = [(0, len(raw))]
                else:
                    spans = []
                    for low, high in sorted((r["start"], r["start"] + r["strings"] + length - 1) for r in removed or ()):
                        if spans and low <= spans[-1][1]:
                            spans[-1] = (spans[-1][0], max(high, spans[-1][1]))
                        else:
                            spans.append((low, high))
                digest, at = hashlib.sha256(), 0
                for low, high in spans:
                    digest.update(raw[at:low])
                    at = high
                digest.update(raw[at:])
                out.append((len(raw), sum(b - a for a, b in spans), len(spans), digest.hexdigest(), ",".join(f"{a}:{b}" for a, b in spans)))
            columns = list(zip(*out)) or [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("text_key"), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=[x.split()[0] for x in RESULT.split(", ")],
            )

    return run


def _told_apart(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal pieces of a shard: the later ones (all their strings go), and the first of each."""
    spark, hashes = pieces.sparkSession, ["shard", "high", "low"]
    owners = pieces.groupBy(*hashes).agg(F.min(F.struct("row_key", "start")).alias("owner"), F.count("*").alias("n"))
    owners = owners.filter("n > 1").select(*hashes, F.col("owner.row_key").alias("owner"), F.col("owner.start").alias("place"))
    owners = stored(spark, owners, "piece-owners")
    bare = pieces.select(*KEYS, *hashes, "start", "strings")
    later = bare.join(owners, hashes).filter("row_key > owner or row_key = owner and start > place").select(*KEYS, "start", "strings")
    firsts = pieces.join(owners, hashes, "left").filter("owner is null or row_key = owner and start = place")
    return later, stored(spark, firsts.select(*KEYS, "shard", "lead", "start", "strings", "content"), "distinct-pieces")


def repeated_strings(texts: DataFrame, length: int = 100, shard_bytes: int = 1 << 21, chunk_bytes: int = 1 << 20) -> DataFrame:
    """``row_key, text_key, removed (runs of strings with an earlier equal one), whole (a copy of a smaller id)``."""
    spark = texts.sparkSession
    whole = stored(spark, copies(texts), "copies")
    seeds = texts.mapInArrow(_seeds(length), SEEDS)
    live = stored(spark, seeds.groupBy("seed").agg(F.sum("n").alias("n")).filter("n > 1").select("seed"), "live-seeds")
    spots = seeds.drop("n").join(live, "seed").groupBy(*KEYS).agg(F.collect_set("seed").alias("seeds"))
    spots = spots.join(whole, KEYS, "left_anti")
    segments = texts.join(spots, KEYS).select(*KEYS, "text", "seeds").mapInArrow(_segments(length), SEGMENTS)
    lost, firsts = _told_apart(stored(spark, segments, "segments"))
    ready = None
    for width in CELLS:
        sizes = firsts.groupBy("shard").agg(F.sum(F.length("content")).alias("bytes"))
        large = stored(spark, sizes.filter(F.col("bytes") > shard_bytes).select("shard"), "large-shards")
        if not large.take(1):
            break
        small = firsts.join(large, "shard", "left_anti")
        ready = small if ready is None else ready.union(small)
        pieces = stored(spark, firsts.join(large, "shard").mapInArrow(_cells(length, width), SEGMENTS), "pieces")
        later, firsts = _told_apart(pieces)
        lost = lost.union(later)
        shared = firsts.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1").select("shard")
        firsts = firsts.join(stored(spark, shared, "shared-shards"), "shard").select(*firsts.columns)
    ready = firsts if ready is None else ready.union(firsts)
    shards = ready.select("shard", *KEYS, "start", "content").repartition("shard").sortWithinPartitions("shard")
    settled = stored(spark, shards.mapInArrow(_shards(length, chunk_bytes), LOST), "settled-strings")
    lost = lost.union(settled).groupBy(*KEYS).agg(F.collect_set(F.struct("start", "strings")).alias("removed"))
    return lost.join(whole.withColumn("whole", F.lit(True)), KEYS, "full")


def byte_dedup(docs: DataFrame, length: int = 100, **sizes) -> DataFrame:
    """One row per document: bytes, bytes removed, removed runs, a digest of the rest, ``removed`` as ``from:to`` pairs."""
    texts = keyed(docs)
    marked = texts.join(repeated_strings(texts, length, **sizes), KEYS, "left").select(*KEYS, "text", "removed", "whole")
    return named(marked.mapInArrow(_kept(length), RESULT))

"""N-gram Jaccard join by a forest of count-vector R-trees.

Method (count-vector R-tree): the word shingles of a document are hashed; their counts over 64 groups
are its point. The overlap of two sets is at most the sum of the coordinate minima of their points,
and for whole tree nodes that of the nodes' coordinate maxima. With a similarity of 0.8 two sets of
sizes m and n must overlap in 4/9 (m + n) shingles at least; what can't is pruned, what survives is
verified on the whole sets. For single points the parities of counts over 512 finer groups bound once
more: every group where they differ holds a shingle that only one of the sets has, and there may be
(m + n) / 9 of those.

The forest's top level splits on single shingles: of each set only the rarest fifth (and one more)
is looked at, because without one of these in common the minima over the rest stay below the bound.
Shingles in very many documents come last in that order; the list of them has at most ``hot_limit``
entries, since each needs its share of all rows. So each tree holds the documents that share one
shingle, and the lower levels bound whole groups of them by size and counts.

Every pair that the bounds leave is verified, also within a group that is connected already, so the
links are all links between different sets; components come from them. Trees of more than ``tile``
documents are dealt to several tasks, pair of parts by pair of parts. Documents with equal sets are one
point. Pairs never become rows: a tree gives one row per group of points that its pairs connect, with a
compressed grid of bits. What all trees connect is verified together in one cell, to which each text goes
once; a cell takes a pair that several trees found once. Where that would be over ``BLOCK`` points or
``VOLUME`` shingles, each tree's group is a cell of its own (or, above the same limits, each pair of its
blocks), and a pair counts in the tree of the least shingle of both only. A cell gives one row per point: how
many links it has, and one point of its component.

Edge cases: a null text, or one without words, has no shingles and is linked with nothing; with fewer
than five words the whole sequence is one shingle; a null id sorts after every other; repeated rows
get equal rows; an empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.arrays import FIRST, LOWER, mix, text_slices, words
from riskloom.llm.contamination import Members
from riskloom.llm.frames import keyed, named, stored
from riskloom.llm.graph import components
from riskloom.llm.repeats import KEYS

SHINGLE, GROUPS, FINE, FULL, FAN = 5, 64, 512, 255, 8
HEADS, NONE = 8, (1 << 63) - 1
#: Points and shingles of a cell, or of each of the two blocks that a cell compares.
BLOCK, VOLUME = 1024, 1 << 19
POINTS = "row_key long, text_key long, n long, point long, counts binary"
ENTRIES = "shingle long, point long"


def shingles(data, bounds):
    """Sorted distinct shingle hashes of the texts of a slice, one after the other, and their texts' numbers."""
    n = len(bounds) - 1
    starts, ends, doc = words(LOWER[data], bounds)
    sums = FIRST.sums(FIRST.words(LOWER[data], starts, ends))
    count = np.bincount(doc, minlength=n)
    at = np.flatnonzero(doc[: max(0, len(doc) - SHINGLE + 1)] == doc[SHINGLE - 1 :])
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    begin = np.searchsorted(doc, short)
    low, high = np.concatenate([at, begin]), np.concatenate([at + SHINGLE, begin + count[short]])
    hashes, owner = FIRST.span(sums, low, high) + (high - low).astype(np.uint64), np.concatenate([doc[at], short])
    order = np.argsort(owner, kind="stable")
    hashes, owner = hashes[order], owner[order]
    edge = np.searchsorted(owner, np.arange(n + 1))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        hashes[a:b].sort()
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], owner[fresh]


def _identity(hashes, owner, n):
    """One number for each set."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(0x5EED)), dtype=np.uint64)])
    edge = np.searchsorted(owner, np.arange(n + 1))
    return mix((sums[edge[1:]] - sums[edge[:-1]]) + np.diff(edge).astype(np.uint64)), np.diff(edge)


def _points(batches):
    for batch in batches:
        for first, last, data, bounds in text_slices(batch.column("text")):
            rows, n = batch.slice(first, last - first), last - first
            hashes, owner = shingles(data, bounds)
            point, size = _identity(hashes, owner, n)
            cells = np.bincount(owner * GROUPS + (hashes >> np.uint64(58)).astype(np.int64), minlength=n * GROUPS)
            cells = np.minimum(cells, FULL).astype(np.uint8).reshape(n, GROUPS)
            fine = np.bincount(owner * FINE + (hashes >> np.uint64(40)).astype(np.int64) % FINE, minlength=n * FINE)
            cells = np.concatenate([cells, np.packbits((fine & 1).astype(np.uint8).reshape(n, FINE), axis=1)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [rows.column("row_key"), rows.column("text_key"), pa.array(size.astype(np.int64)), pa.array(point.view(np.int64)), pa.array([c.tobytes() for c in cells], pa.binary())],
                names=["row_key", "text_key", "n", "point", "counts"],
            )


def _entries(shared=None):
    """The rarest fifth of each set, and one more: shingles not known to be frequent first."""

    def run(batches):
        hot = Members(shared.value) if shared is not None else None
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column("text")):
                n = last - first
                hashes, owner = shingles(data, bounds)
                if not len(hashes):
                    continue
                point, size = _identity(hashes, owner, n)
                frequent = np.zeros(len(hashes), dtype=bool)
                if hot is not None:
                    frequent[hot.find(hashes)] = True
                    order = np.lexsort((frequent, owner))  # stable: by hash within
                    hashes, owner, frequent = hashes[order], owner[order], frequent[order]
                begin = np.searchsorted(owner, np.arange(n))
                rank = np.arange(len(hashes)) - begin[owner]
                taken = rank < (size - (4 * size + 4) // 5 + 1)[owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[taken].view(np.int64)), pa.array(point[owner[taken]].view(np.int64))], names=["shingle", "point"]
                )

    return run


def _vectors(column):
    """Counts as a matrix (a full cell bounds nothing), and the parities of the finer ones in 64-bit words."""
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, GROUPS + FINE // 8)
    counts = flat[:, :GROUPS].astype(np.int32)
    return np.where(counts == FULL, 1 << 20, counts), np.ascontiguousarray(flat[:, GROUPS:]).view(np.uint64)


def _differ(a, b):
    """In how many fine groups the parities differ: so many shingles at least are in one set only."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


class Forest:
    """R-trees over rows that are in order of their tree, packed ``FAN`` to a node by size.

    Rows of one ``side`` aren't paired: in a tile of two parts that is the part, else each row's own.
    """

    def __init__(self, tree, size, vectors, parities, side):
        self.parities = parities
        self.levels = [(np.arange(len(tree)), np.arange(len(tree)) + 1, vectors, size, size, side, side, tree)]
        while len(self.levels[-1][0]) > len(np.unique(self.levels[-1][7])):
            _, _, most, low, high, least, last, owner = self.levels[-1]
            begin = np.searchsorted(owner, owner)
            head = np.flatnonzero((np.arange(len(owner)) - begin) % FAN == 0)
            self.levels.append(
                (
                    head, np.append(head[1:], len(owner)), np.maximum.reduceat(most, head), np.minimum.reduceat(low, head),
                    np.maximum.reduceat(high, head), np.minimum.reduceat(least, head), np.maximum.reduceat(last, head), owner[head],
                )
            )

    def _keep(self, level, i, j, block=1 << 16):
        _, _, most, low, high, least, last, _ = self.levels[level]
        good = (least[i] != last[i]) | (least[j] != last[j]) | (least[i] != least[j])  # not all of one side
        good &= (5 * high[i] >= 4 * low[j]) & (5 * high[j] >= 4 * low[i])
        if level == 0:
            good &= i != j
        i, j = i[good], j[good]
        keep = np.zeros(len(i), dtype=bool)
        for at in range(0, len(i), block):
            a, b = i[at : at + block], j[at : at + block]
            bound = np.minimum(most[a], most[b]).sum(axis=1)
            keep[at : at + block] = 9 * bound >= 4 * (low[a] + low[b])
            if level == 0:
                keep[at : at + block] &= 9 * _differ(self.parities[a], self.parities[b]) <= low[a] + low[b]
        return i[keep], j[keep]

    def pairs(self, part=1 << 18):
        """Yield pairs of rows that may link: level by level, a part at a time."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        work = [(top, *self._keep(top, roots, roots))]
        while work:
            level, i, j = work.pop()
            if level == 0:
                yield i, j
                continue
            if len(i) > part // (FAN * FAN):
                half = len(i) // 2
                work += [(level, i[:half], j[:half]), (level, i[half:], j[half:])]
                continue
            begin, end = self.levels[level][:2]
            wide = end[j] - begin[j]
            count = (end[i] - begin[i]) * wide
            of = np.repeat(np.arange(len(i)), count)
            k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            a, b = begin[i[of]] + k // wide[of], begin[j[of]] + k % wide[of]
            ordered = a <= b
            if len(of):
                work.append((level - 1, *self._keep(level - 1, a[ordered], b[ordered])))


def _canonical(shingle, heads_a, heads_b):
    """Whether a pair belongs to this tree: the least of the heads both share, or any if they share none."""
    least = np.full(len(shingle), NONE)
    for k in range(HEADS):
        shared = (heads_b == heads_a[:, k : k + 1]).any(axis=1) & (heads_a[:, k] != NONE)
        least = np.minimum(least, np.where(shared, heads_a[:, k], NONE))
    return (least == NONE) | (least == shingle)


def _labels(n, a, b):
    """For each of n points the least one that pairs (a, b) connect it with."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        old = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        np.minimum.at(label, old, label)  # also for those that had the same label before
        label = label[label]
        if (label == old).all():
            return label


def _forests(chunk: int = 8192):
    """Groups of points that may link: their numbers, and a grid of bits that says which pairs."""

    def solve(rows):
        columns = [np.concatenate(x) for x in zip(*rows)]
        order = np.lexsort((columns[3], columns[1], columns[0]))
        tree, size, side, point, shingle, heads, vectors, parities = (c[order] for c in columns)
        found = [np.empty((2, 0), dtype=np.int32)]
        for i, j in Forest(tree, size, vectors, parities, side).pairs():
            own = _canonical(shingle[i], heads[i], heads[j])
            found.append(np.stack([i[own], j[own]]).astype(np.int32))
        i, j = np.concatenate(found, axis=1)
        if not len(i):
            return
        group = _labels(len(point), i, j)[i]
        order = np.argsort(group, kind="stable")
        i, j, group = i[order], j[order], group[order]
        edge = np.flatnonzero(np.diff(group, prepend=-1))
        out = []
        for low, high in zip(edge, np.append(edge[1:], len(group))):
            names, at = np.unique(point[np.concatenate([i[low:high], j[low:high]])], return_index=True)
            volume = size[np.concatenate([i[low:high], j[low:high]])[at]].sum()
            grid = np.zeros((len(names), len(names)), dtype=bool)
            grid[np.searchsorted(names, point[i[low:high]]), np.searchsorted(names, point[j[low:high]])] = True
            packed = zlib.compress(np.packbits(grid | grid.T).tobytes(), 1)
            out.append((int(names[0]), int(shingle[i[low]]), int(volume), names.tobytes(), packed))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["point", "shingle", "volume", "names", "grid"])

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "n", "side", "point", "shingle")]
            columns.append(np.frombuffer(b"".join(batch.column("heads").to_pylist()), dtype=">i8").astype(np.int64).reshape(-1, HEADS))
            columns += _vectors(batch.column("counts"))
            # a tree is never cut: what is complete is solved, the last tree waits for more
            begin = 0
            while begin < len(columns[0]):
                rest = columns[0][begin:]
                edge = int(np.searchsorted(rest, rest[0], side="right"))
                if size >= chunk and rest[0] != rows[-1][0][-1]:
                    yield from solve(rows)
                    rows, size = [], 0
                rows.append([c[begin : begin + edge] for c in columns])
                size += edge
                begin += edge
        if rows:
            yield from solve(rows)

    return run


def _ways(batches):
    """One link from the first point of a group to each of the others."""
    for batch in batches:
        for names in batch.column("names"):
            names = np.frombuffer(names.as_py(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names) - 1, names[0])), pa.array(names[1:])], names=["a", "b"])


def _to_cells(batches):
    """A group's grid for each cell that some of its points are in."""
    for batch in batches:
        out = []
        for root, tile, blocks, shingle, names, grid in zip(*(batch.column(c).to_pylist() for c in ("root", "tile", "blocks", "shingle", "names", "grid"))):
            own = np.unique(np.frombuffer(names, dtype=np.int64) % blocks).tolist()
            out += [(root, tile, a * blocks + b, blocks, shingle, names, grid) for k, a in enumerate(own) for b in own[k:]]
        if out:
            kinds = (*[pa.int64()] * 5, pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in CELLS.split(", ")])


def _members(batches):
    """The points of each group."""
    for batch in batches:
        for root, tile, blocks, names in zip(*(batch.column(c).to_pylist() for c in ("root", "tile", "blocks", "names"))):
            names = np.frombuffer(names, dtype=np.int64)
            fixed = [pa.array(np.full(len(names), v)) for v in (root, tile, blocks)]
            yield pa.RecordBatch.from_arrays([*fixed, pa.array(names)], names=["root", "tile", "blocks", "point"])


def _heads(hashes, hot):
    """The entries of one set, as :func:`_entries` takes them, in ascending order."""
    frequent = np.zeros(len(hashes), dtype=bool)
    frequent[hot.find(hashes)] = True
    taken = np.concatenate([hashes[~frequent], hashes[frequent]])[: len(hashes) - (4 * len(hashes) + 4) // 5 + 1]
    return np.sort(taken.view(np.int64))


def _pack(batches):
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = pa.array([squeeze((t or "").encode()) for t in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("text_key"), texts], names=["row_key", "text_key", "packed"])


def _overlaps(sets, a, b):
    """How many hashes the sets ``a`` and ``b`` (positions, in order of ``a``) have in common."""
    size = np.array([len(x) for x in sets])
    edge = np.concatenate([[0], np.cumsum(size)])
    terms = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(len(terms) + 1, dtype=bool)
    both = np.zeros(len(a), dtype=np.int64)
    begin = np.flatnonzero(np.diff(a, prepend=-1))
    for low, high in zip(begin, np.append(begin[1:], len(a))):
        own = terms[edge[a[low]] : edge[a[low] + 1]]
        mark[own] = True
        for k in range(low, high):
            both[k] = np.count_nonzero(mark[terms[edge[b[k]] : edge[b[k] + 1]]])
        mark[own] = False
    return size, both


def _least_shared(heads, a, b, shingle, block=1 << 14):
    """Which pairs have ``shingle`` as the least entry of both. Where their least ``HEADS`` meet, the tree has seen to it."""
    first = np.full((max(heads, default=0) + 1, HEADS), NONE)
    for k, own in heads.items():
        first[k, : min(HEADS, len(own))] = own[:HEADS]
    keep = np.zeros(len(a), dtype=bool)
    for at in range(0, len(a), block):
        x, y = first[a[at : at + block]], first[b[at : at + block]]
        keep[at : at + block] = ((x[:, :, None] == y[:, None, :]) & (x[:, :, None] != NONE)).any(axis=(1, 2))
    for k in np.flatnonzero(~keep).tolist():
        keep[k] = np.intersect1d(heads[int(a[k])], heads[int(b[k])], True)[0] == shingle
    return keep


def _verify(shared):
    """Links of each cell's points; its texts (rows without ``grid``) come before its grids."""
    import zstandard

    def run(batches):
        open_, hot = zstandard.ZstdDecompressor().decompress, Members(shared.value)
        at, names, sets, grids = None, [], [], []

        def solve():
            if not grids:
                return
            order = np.argsort(points := np.array(names, dtype=np.int64))
            points, own, tile = points[order], [sets[k] for k in order], at[1]
            pairs = np.zeros((len(points), len(points)), dtype=bool)
            for blocks, _, members, grid in grids:
                members = np.frombuffer(members, dtype=np.int64)
                wide = np.unpackbits(np.frombuffer(zlib.decompress(grid), dtype=np.uint8), count=len(members) ** 2).reshape(len(members), -1)
                block = members % blocks
                here = np.flatnonzero((block == at[2] // blocks) | (block == at[2] % blocks))
                wide, block, place = wide[np.ix_(here, here)].astype(bool), block[here], np.searchsorted(points, members[here])
                if at[2] // blocks != at[2] % blocks:  # pairs within a block have a cell of their own
                    wide &= block[:, None] != block
                pairs[np.ix_(place, place)] |= wide
            a, b = np.nonzero(np.triu(pairs, 1))
            size, both = _overlaps(own, a, b)
            good = np.flatnonzero(100 * both >= 80 * (size[a] + size[b] - both))
            if tile:  # other trees may hold the pair too: it belongs to that of the least shingle of both
                heads = {int(k): _heads(own[k], hot) for k in np.unique(np.concatenate([a[good], b[good]]))}
                good = good[_least_shared(heads, a[good], b[good], grids[0][1])]
            a, b = a[good], b[good]
            links = np.bincount(np.concatenate([a, b]), minlength=len(points))
            linked = np.flatnonzero(links)
            if len(linked):
                least = _labels(len(points), a, b)[linked]
                yield pa.RecordBatch.from_arrays([pa.array(points[linked]), pa.array(links[linked]), pa.array(points[least])], names=["point", "n", "other"])

        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("root", "tile", "cell"))))
            for k, place in enumerate(places):
                if place != at:
                    yield from solve()
                    at, names, sets, grids = place, [], [], []
                if batch.column("grid")[k].is_valid:
                    grids.append(tuple(batch.column(c)[k].as_py() for c in ("blocks", "shingle", "names", "grid")))
                else:
                    data = np.frombuffer(open_(batch.column("packed")[k].as_buffer()), dtype=np.uint8)
                    names.append(batch.column("point")[k].as_py())
                    sets.append(shingles(data, np.array([0, len(data)]))[0])
        yield from solve()

    return run


PAIR = "a long, b long"
GRIDS = "point long, shingle long, volume long, names binary, grid binary"
CELLS = "root long, tile long, cell long, blocks long, shingle long, names binary, grid binary"


class _Join:
    def __init__(self, texts: DataFrame, hot_limit: int, hot_least: int, tile: int):
        self.spark, self.texts, self.tile = texts.sparkSession, texts, tile
        self.hot_limit, self.hot_least = hot_limit, hot_least

    def store(self, frame, label):
        return stored(self.spark, frame, label)

    def frequent(self):
        """Shingles that come last: each has over 1/``hot_limit`` of all entries, so there are fewer than that."""
        counts = self.texts.mapInArrow(_entries(), ENTRIES).groupBy("shingle").agg(F.count("*").alias("n"))
        counts = self.store(counts.filter(F.col("n") > self.hot_least), "frequent-shingles")
        total = counts.agg(F.sum("n")).first()[0] or 0
        limit = max(self.hot_least, -(-total // self.hot_limit))
        found = counts.filter(F.col("n") > limit).select("shingle").toArrow().column(0)
        return self.spark.sparkContext.broadcast(found.to_numpy().astype(np.int64).view(np.uint64))

    def packed(self, wanted):
        """Compressed texts of some points."""
        places = self.points.join(wanted, "point").select("point", "row_key", "text_key")
        texts = self.texts.mapInArrow(_pack, "row_key long, text_key long, packed binary")
        return texts.join(places, KEYS).select("point", "packed").dropDuplicates(["point"])

    def verified(self, groups, hot):
        """``point, n, other``: how many links a point has in a cell, and one point of its component there."""
        near = self.store(components(groups.mapInArrow(_ways, PAIR)), "candidate-groups")
        near = near.withColumnRenamed("node", "point").join(self.points.select("point", "n"), "point")
        sizes = near.groupBy("root").agg(F.count("*").alias("size"), F.sum("n").alias("all"))
        sizes = self.store(sizes.select("root", ((F.col("size") > BLOCK) | (F.col("all") > VOLUME)).alias("large")), "group-sizes")
        near = self.store(near.select("point", "root").join(sizes, "root"), "placed")
        blocks = F.greatest(F.length("names") / 8 / BLOCK, F.col("volume") / VOLUME)
        placed = groups.join(near, "point").select(
            "root",
            F.when(F.col("large"), F.xxhash64("shingle", "names").bitwiseOR(F.lit(1).cast("long"))).otherwise(0).alias("tile"),
            F.when(F.col("large"), F.ceil(blocks)).otherwise(1).cast("long").alias("blocks"),
            "shingle", "names", "grid",
        )
        placed = self.store(placed, "placed-groups")
        single = near.filter("not large").select("root", F.lit(0).cast("long").alias("tile"), F.lit(1).cast("long").alias("blocks"), "point")
        spread = placed.filter("tile <> 0").mapInArrow(_members, "root long, tile long, blocks long, point long")
        block = F.pmod("point", "blocks")
        texts = (
            single.unionByName(spread)
            .join(self.store(self.packed(near.select("point")), "packed-texts"), "point")
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumn("cell", F.least(block, "block") * F.col("blocks") + F.greatest(block, "block"))
        )
        rows = texts.select("root", "tile", "cell", "point", "packed").unionByName(placed.mapInArrow(_to_cells, CELLS), allowMissingColumns=True)
        cells = ["root", "tile", "cell"]
        ready = rows.repartition(*cells).sortWithinPartitions(*cells, F.col("blocks").asc_nulls_first())
        return self.store(ready.mapInArrow(_verify(hot), "point long, n long, other long"), "links")

    def run(self):
        members = self.store(self.texts.mapInArrow(_points, POINTS), "points")
        points = members.filter("n > 0").groupBy("point").agg(F.min(F.struct("row_key", "text_key")).alias("at"), F.first("n").alias("n"), F.first("counts").alias("counts"))
        self.points = self.store(points.select("point", "n", "counts", "at.row_key", "at.text_key"), "distinct-points")
        hot = self.frequent()
        entries = self.texts.mapInArrow(_entries(hot), ENTRIES)
        trees = entries.groupBy("shingle").agg(F.min("point").alias("first"), F.max("point").alias("last")).filter("first < last")
        trees = self.store(trees.select("shingle"), "trees")
        entries = self.store(entries.join(trees, "shingle").distinct(), "tree-entries")
        links = self.verified(self.store(self.tree_groups(entries), "tree-groups"), hot)
        hot.unpersist()
        roots = components(links.select(F.col("point").alias("a"), F.col("other").alias("b")))
        return members, links, self.store(roots, "components")

    def tree_groups(self, entries):
        """All pairs that may link, as grids of the groups that each tree connects."""
        sizes = entries.groupBy("shingle").agg(F.count("*").alias("size"))
        sizes = self.store(sizes.select("shingle", F.ceil(F.col("size") / self.tile).cast("int").alias("parts")), "tree-sizes")
        least = F.slice(F.sort_array(F.collect_list("shingle")), 1, HEADS)
        heads = entries.groupBy("point").agg(least.alias("least"))
        head = [F.unhex(F.lpad(F.hex(F.coalesce(F.get("least", F.lit(k)), F.lit(NONE))), 16, "0")) for k in range(HEADS)]
        points = self.store(self.points.join(heads, "point").select("point", "n", "counts", F.concat(*head).alias("heads")), "tree-points")
        part = F.pmod(F.xxhash64("point"), F.col("parts")).cast("int")
        dealt = (
            entries.join(sizes, "shingle")
            .withColumn("part", part)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("tree", F.when(F.col("parts") == 1, F.col("shingle")).otherwise(F.xxhash64("shingle", F.least("part", "other"), F.greatest("part", "other"))))
            # of two parts, only pairs across: those within a part have a tile of their own
            .withColumn("side", F.when(F.col("part") == F.col("other"), F.col("point")).otherwise(F.col("part").cast("long")))
            .select("tree", "shingle", "point", "side")
            .join(points, "point")
        )
        return dealt.repartition("tree").sortWithinPartitions("tree").mapInArrow(_forests(), GRIDS)


def near_duplicates(docs: DataFrame, hot_limit: int = 1 << 19, hot_least: int = 64, tile: int = 2048) -> DataFrame:
    """One row per document: ``n_shingles``, ``component_id`` (the smallest doc_id it is linked with), ``n_links`` and
    ``component`` (one number for each component, also where ids repeat).

    ``n_links`` counts the other distinct sets that the document's set is linked with, all of them.
    """
    texts = keyed(docs)
    members, links, roots = _Join(texts, hot_limit, hot_least, tile).run()
    members = members.select("row_key", "text_key", F.col("n").alias("n_shingles"), "point")
    rooted = members.join(roots.withColumnRenamed("node", "point"), "point", "left").withColumn("root", F.coalesce("root", "point"))
    least = rooted.groupBy("root").agg(F.min("row_key").alias("component_id"))
    least = stored(docs.sparkSession, least, "least-ids")
    degrees = stored(docs.sparkSession, links.groupBy("point").agg(F.sum("n").alias("n_links")), "degrees")
    out = rooted.join(least, "root").join(degrees, "point", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("row_key"))
    # sets without shingles share a point but no component
    alone = F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.xxhash64("row_key", "text_key"))
    out = out.select("row_key", "text_key", "n_shingles", own.alias("component_id"), "n_links", alone.alias("component"))
    return named(named(out), "component_id", "component_id")

"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard.

Vectors of one label and one dimension are compared. Equal vectors become one point with a weight first.
Points are dealt to shards of bounded size; a task builds the graph of its shard from the first rows of
its sorted input and streams the queries behind them through it: the shard's own points and those of
all shards with a smaller number, so every pair of shards is searched once. Memory is bounded by a
shard, a batch of queries and their beams.

A search keeps the ``beam`` nearest points it has seen. The beam is doubled for all queries until an
audit, which compares some queries with the whole shard, finds ``least_recall`` of the links, and for single
queries while their whole beam is linked. Once an eighth of a shard would be in it, the beam is the
shard. Cosines of links are taken in double precision.

What leaves a task grows with its points, not with its links: counts of links per point, and links
that span the components found in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.graph import components
from riskloom.workspace import written

MIN_COSINE = 0.93
#: Floats of a shard: at 64 dimensions 131,072 points.
SHARD_VALUES = 1 << 23
#: Queries that are searched together, and float entries a block of exact cosines may have.
TOGETHER, BLOCK = 256, 1 << 21
#: Beams that are full of links grow up to this; beyond it the point is compared with the whole shard.
WIDEST = 256
AUDITED, LEAST_RECALL = 64, 0.99


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows in double precision at length one."""
    # the largest entry first: squares of very large or small ones would not be finite
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


class Graph:
    """Layers of neighbour lists over ``points`` (unit rows), the sparsest first searched."""

    def __init__(self, points: np.ndarray, degree: int = 12, effort: int = 48, seed: int = 5):
        self.points, self.degree, self.effort = points, degree, effort
        n = len(points)
        draws = np.random.default_rng(seed).random(n)
        level = np.minimum(np.floor(-np.log(1 - draws) / np.log(degree)).astype(np.int64), 8)
        # the points of a layer are the first ones of this order
        self.order = np.argsort(-level, kind="stable")
        self.vectors = np.ascontiguousarray(points[self.order], dtype=np.float32)
        sizes = [int((level >= k).sum()) for k in range(int(level.max(initial=0)) + 1)]
        self.layers: list[np.ndarray] = []
        for k in reversed(range(len(sizes))):
            self.layers.append(self._layer(sizes[k], degree * (2 if k == 0 else 1)))

    def _layer(self, size: int, width: int) -> np.ndarray:
        links = np.full((size, width), -1, dtype=np.int32)
        done = min(size, 64)
        self._connect(links, np.arange(done), np.tile(np.arange(done, dtype=np.int32), (done, 1)))
        while done < size:
            new = np.arange(done, min(size, done + min(done, TOGETHER)))
            entry = self._descend(self.vectors[new], len(self.layers))
            entry = np.where(entry < done, entry, 0)  # a layer takes the points of those above in first
            near, _ = self._beam(links, self.vectors[new], entry, self.effort, done)
            # points that come in together see each other too
            own = np.tile(new.astype(np.int32), (len(new), 1))
            self._connect(links, new, np.concatenate([near, own], axis=1))
            done = int(new[-1]) + 1
        return links

    def _chosen(self, at: np.ndarray, near: np.ndarray, width: int) -> np.ndarray:
        """Of each row of candidates the ``width`` to keep: closer to the point than to those kept before."""
        near = np.where(near == at[:, None], -1, near)
        cosine = np.einsum("bmd,bd->bm", self.vectors[near], self.vectors[at])
        cosine[near < 0] = -4
        most = min(near.shape[1], 2 * width + 8)
        order = np.argsort(-cosine, axis=1, kind="stable")[:, :most]
        near, cosine = np.take_along_axis(near, order, 1), np.take_along_axis(cosine, order, 1)
        cosine[:, 1:][near[:, 1:] == near[:, :-1]] = -4  # a candidate twice
        both = np.matmul(self.vectors[near], self.vectors[near].transpose(0, 2, 1))
        kept = np.zeros(near.shape, dtype=bool)
        for j in range(most):
            blocked = (np.where(kept, both[:, :, j], -4) > cosine[:, j : j + 1]).any(axis=1)
            kept[:, j] = ~blocked & (cosine[:, j] > -4) & (kept.sum(axis=1) < width)
        # places left over go to the nearest of the others
        rank = np.argsort(np.where(cosine <= -4, 2, np.where(kept, 0, 1)), axis=1, kind="stable")[:, :width]
        out = np.take_along_axis(np.where(cosine > -4, near, -1), rank, 1)
        return np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1).astype(np.int32)

    def _connect(self, links: np.ndarray, new: np.ndarray, near: np.ndarray) -> None:
        """Link new points with their candidates, both ways."""
        width = links.shape[1]
        for i in range(0, len(new), TOGETHER):
            at = new[i : i + TOGETHER]
            links[at, : self.degree] = self._chosen(at, near[i : i + TOGETHER], self.degree)
        source = np.repeat(new, width)
        target = links[new].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.empty(0, np.int64)
        rank = np.arange(len(target)) - np.repeat(first, np.diff(np.r_[first, len(target)]))
        few = rank < 2 * width  # of one batch; the diverse choice below keeps ``width`` at most
        back = np.full((len(first), 2 * width), -1, dtype=np.int32)
        row = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(target)]))
        back[row[few], rank[few]] = source[few]
        at = target[first]
        for i in range(0, len(at), TOGETHER):
            part = at[i : i + TOGETHER]
            links[part] = self._chosen(part, np.concatenate([links[part], back[i : i + TOGETHER]], axis=1), width)

    def _descend(self, queries: np.ndarray, layers: int) -> np.ndarray:
        """Where to begin below the first ``layers`` layers: the nearest points of the last of them."""
        entry = np.zeros((len(queries), 1), dtype=np.int32)
        for links in self.layers[:layers]:
            entry, _ = self._beam(links, queries, entry, 4, len(links))
        return entry

    def _beam(self, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int, size: int, steps: int = 4):
        """The ``beam`` nearest points of a layer that a best-first search sees, and their cosines, descending."""
        n = len(queries)
        ids = np.full((n, beam), -1, dtype=np.int32)
        cosines = np.full((n, beam), -4, dtype=np.float32)
        opened = np.ones((n, beam), dtype=bool)
        seen = np.zeros((n, size + 1), dtype=bool)  # the last one stands for no point
        active, fresh = np.arange(n), np.sort(entry, axis=1)
        while len(active):
            rows = np.arange(len(active))[:, None]
            fresh = np.where((fresh < 0) | seen[active[:, None], fresh], size, fresh)
            fresh.sort(axis=1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = size
            seen[active[:, None], fresh] = True
            seen[:, size] = False
            new = np.einsum("bmd,bd->bm", self.vectors[np.minimum(fresh, size - 1)], queries[active])
            new[fresh == size] = -4
            every = np.concatenate([cosines[active], new], axis=1)
            names = np.concatenate([ids[active], np.where(fresh == size, -1, fresh).astype(np.int32)], axis=1)
            was = np.concatenate([opened[active], fresh == size], axis=1)
            best = np.argsort(-every, axis=1, kind="stable")[:, :beam]
            cosines[active], ids[active] = every[rows, best], names[rows, best]
            opened[active] = was[rows, best]
            # open the nearest that are not open yet
            todo = np.argsort(opened[active], axis=1, kind="stable")[:, :steps]
            fit = ~opened[active[:, None], todo]
            going = fit.any(axis=1)
            active, todo, fit = active[going], todo[going], fit[going]
            if not len(active):
                break
            at = ids[active[:, None], todo]
            opened[active[:, None], todo] = True
            fresh = np.where(fit[:, :, None], links[np.minimum(np.maximum(at, 0), size - 1)], -1).reshape(len(active), -1)
        return ids, cosines

    def search(self, queries: np.ndarray, beam: int):
        """The ``beam`` nearest points seen, as positions in ``points`` (-1: none), and their cosines."""
        ids, cosines = self._beam(self.layers[-1], queries, self._descend(queries, len(self.layers) - 1), beam, len(self.vectors))
        return np.where(ids < 0, -1, self.order[ids]), cosines


class Shard:
    """The points of a shard, their graph, and what has been linked so far."""

    def __init__(self, ids, weights, vectors, min_cosine, beam, audited, least_recall):
        self.ids, self.weights, self.points = ids, weights, _unit(vectors)
        self.min_cosine, self.beam, n = min_cosine, beam, len(ids)
        self.least = np.float32(min_cosine - 1e-4)  # a graph's cosines are single precision
        self.counts, self.root = np.zeros(n, dtype=np.int64), np.arange(n)
        self.graph = Graph(self.points) if 8 * beam < n else None
        self.widen(audited, least_recall)

    @property
    def whole(self) -> bool:
        """Whether the beam is the shard."""
        return self.graph is None or 8 * self.beam >= len(self.ids)

    def widen(self, audited: int, least_recall: float) -> None:
        """Double the beam until enough links of the audited points are found."""
        sample = np.unique(np.linspace(0, len(self.ids) - 1, audited).astype(np.int64))
        queries = self.points[sample]
        truth = {(i, int(j)) for i, row in enumerate(self._exact(queries)) for j in np.flatnonzero(row)} if not self.whole else set()
        while not self.whole:
            found = set()
            for i, hits, _ in self._linked(queries):
                found.update((int(i), int(j)) for j in hits)
            if len(found & truth) >= least_recall * len(truth):
                return
            self.beam *= 2

    def _exact(self, queries: np.ndarray) -> Iterator[np.ndarray]:
        step = max(1, BLOCK // max(1, len(self.points)))
        for i in range(0, len(queries), step):
            yield from queries[i : i + step] @ self.points.T >= self.min_cosine

    def _linked(self, queries: np.ndarray):
        """``(query, positions of its links, whole)``, in no order; ``whole``: compared with all points.

        A beam that is full of links is doubled, up to ``WIDEST``.
        """
        todo, beam = np.arange(len(queries)), self.beam
        while len(todo) and not self.whole and beam <= max(self.beam, min(WIDEST, len(self.ids) // 8)):
            full = []
            for i in range(0, len(todo), TOGETHER):
                part = todo[i : i + TOGETHER]
                ids, cosines = self.graph.search(queries[part].astype(np.float32), beam)
                over = (cosines[:, -1] >= self.least) & (ids[:, -1] >= 0)
                full.append(part[over])
                for q, row, cosine in zip(part[~over], ids[~over], cosines[~over]):
                    hits = row[(cosine >= self.least) & (row >= 0)]
                    yield q, hits[self.points[hits] @ queries[q] >= self.min_cosine], False
            todo, beam = np.concatenate(full), 2 * beam
        for q, row in zip(todo, self._exact(queries[todo])):
            yield q, np.flatnonzero(row), True

    def _find(self, i):
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def _union(self, hits) -> None:
        first = self._find(hits[0])
        # roots of roots at once: groups are large and mostly one already
        up = self.root[hits]
        for j in np.unique(up[up != first]):
            j = self._find(j)
            if j != first:
                self.root[j] = first

    def join_others(self, ids, weights, vectors) -> Iterator[tuple]:
        """Queries of another shard: ``(id, links, a linked id)`` of each that is linked."""
        for q, hits, _ in self._linked(_unit(vectors)):
            if len(hits):
                self.counts[hits] += weights[q]
                self._union(hits)
                yield ids[q], self.weights[hits].sum(), self.ids[hits[0]]

    def join_own(self) -> None:
        """The shard's points with each other: a link found from either side counts, once.

        Points that were compared with the whole shard count their links completely, and lend them to
        the others; of the others each has fewer than ``WIDEST`` links, whose pairs are held.
        """
        n = len(self.ids)
        complete, lent, pairs = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64), []
        for q, hits, whole in self._linked(self.points):
            hits = hits[hits != q]
            if whole:
                complete[q] = True
                self.counts[q] += self.weights[hits].sum()
                lent[hits] += self.weights[q]
            elif len(hits):
                pairs.append(np.minimum(q, hits) * n + np.maximum(q, hits))
            if len(hits):
                self._union(np.r_[q, hits])
        self.counts += np.where(complete, 0, lent)
        if pairs:
            a, b = np.divmod(np.unique(np.concatenate(pairs)), n)
            few = ~(complete[a] | complete[b])
            np.add.at(self.counts, a[few], self.weights[b[few]])
            np.add.at(self.counts, b[few], self.weights[a[few]])

    def found(self) -> Iterator[tuple]:
        """``(id, links, an id of its component)`` of each point."""
        for i in np.flatnonzero((self.counts > 0) | (self.root != np.arange(len(self.ids)))):
            yield self.ids[i], self.counts[i], self.ids[self._find(i)]


def _shards(min_cosine: float, beam: int, audited: int, least_recall: float):
    """Sorted rows of shards to ``key, n, other``: links counted, and a linked key each."""

    def search(batches):
        at, shard, own, out = None, None, [], []

        def opened():
            ids, weights, vectors = (np.concatenate(c) for c in zip(*own))
            own.clear()
            return Shard(ids, weights, vectors, min_cosine, beam, audited, least_recall)

        def put():
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.string()))]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["key", "n", "other"])

        def closed():
            done = shard or opened()
            if at[-1] == 0:
                done.join_own()
            out.extend(done.found())

        for batch in batches:
            names = [tuple(r) for r in zip(*(batch.column(c).to_pylist() for c in ("label", "dimension", "shard", "part")))]
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            begin = 0
            while begin < len(names):
                end = begin + 1
                while end < len(names) and end < begin + TOGETHER and names[end] == names[begin] and asks[end] == asks[begin]:
                    end += 1
                if names[begin] != at:
                    if at is not None:
                        closed()
                    at, shard = names[begin], None
                rows = batch.slice(begin, end - begin)
                ids = np.array(rows.column("key").to_pylist(), dtype=object)
                weights = rows.column("weight").to_numpy()
                vectors = rows.column("vector").flatten().to_numpy().astype(np.float64).reshape(len(ids), -1)
                if asks[begin]:
                    shard = shard or opened()
                    out.extend(shard.join_others(ids, weights, vectors))
                else:
                    own.append((ids, weights, vectors))
                begin = end
                if len(out) > 4096:
                    yield put()
        if at is not None:
            closed()
        if out:
            yield put()

    return search


def _usable(vector: str):
    """Neither null nor zero, without null or non-finite entries."""
    number = F.col(vector)
    good = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return number.isNotNull() & good & F.exists(number, lambda x: x != 0)


def near_vectors(
    embeddings: DataFrame,
    min_cosine: float = MIN_COSINE,
    beam: int = 64,
    shard_values: int = SHARD_VALUES,
    shards_a_part: int = 4,
    audited: int = AUDITED,
    least_recall: float = LEAST_RECALL,
) -> DataFrame:
    """One row per row of ``embeddings (vec_id, embedding, label)``: ``vec_id, n_links, component_id, kept``.

    Two vectors are linked when their labels are equal and not null, their dimensions are equal and the
    cosine is at least ``min_cosine``; ``n_links`` counts the other rows a row is linked with. Links are those that
    the graphs find; ``least_recall`` of those of ``audited`` points of each shard are found at least.
    ``component_id`` is the smallest id that links lead to, ``kept`` tells whether it is the row's own. A null
    id is smaller than no other; rows with one id are different vectors. Vectors that are null, empty or zero, or hold null or
    non-finite entries, and rows without a label, are linked with nothing.
    """
    spark = embeddings.sparkSession
    text = F.concat_ws(",", F.col("label").cast("string"), F.col("embedding").cast("array<string>"))
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        "label",
        F.col("embedding").alias("vector"),
        F.when(F.col("label").isNotNull() & _usable("embedding"), F.md5(text)).alias("key"),
    )
    points = rows.filter("key is not null").groupBy("key").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("least"), F.first("label").cast("string").alias("label"), F.first("vector").alias("vector")
    )
    points = written(spark, points.withColumn("dimension", F.size("vector")), "points")
    sizes = points.groupBy("label", "dimension").agg(F.ceil(F.count("*") * F.first("dimension") / shard_values).cast("long").alias("shards"))
    dealt = points.join(written(spark, sizes, "shard-counts"), ["label", "dimension"]).withColumn(
        "shard", F.pmod(F.xxhash64("key"), F.col("shards"))
    )
    dealt = written(spark, dealt.drop("least"), "dealt")
    columns = ["label", "dimension", "shard", "part", "asks", "key", "weight", "vector"]
    # a part of a shard's work: its graph, asked by some shards of smaller numbers; the first part links its own points
    parts = F.greatest(F.lit(0), F.floor((F.col("shard") - 1) / shards_a_part)).cast("long")
    own = dealt.withColumn("asks", F.lit(False)).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts)))
    others = (
        dealt.filter("shard + 1 < shards")
        .withColumn("asks", F.lit(True))
        .withColumn("part", F.floor(F.col("shard") / shards_a_part).cast("long"))
        .withColumn("shard", F.explode(F.sequence(F.col("shard") + 1, F.col("shards") - 1)))
    )
    found = (
        own.select(*columns)
        .unionByName(others.select(*columns))
        .repartition("label", "dimension", "shard", "part")
        .sortWithinPartitions("label", "dimension", "shard", "part", "asks", "key")
        .mapInArrow(_shards(min_cosine, beam, audited, least_recall), "key string, n long, other string")
    )
    found = written(spark, found, "vector-links")
    roots = written(spark, components(found.select(F.col("key").alias("a"), F.col("other").alias("b"))), "vector-components")
    counts = found.groupBy("key").agg(F.sum("n").alias("n"))
    named = (
        points.select("key", "weight", "least")
        .join(counts, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .select("key", F.coalesce("root", "key").alias("root"), "least", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    named = written(spark, named, "vector-names")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("key", "n_links", "component_id")
    joined = rows.select("vec_id", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )

"""Prefix trie of conversations, rolled up in bands of fixed height.

A node is a distinct sequence of first turns. Its key is a digest of running sums over its turns, so
keys of a conversation of any length come from range-partitioned running sums: no conversation is
collected into one task. Every node is represented by the smallest conversation below it; that
conversation stands for all nodes from some depth downwards, so (conv_id, depth) names a node and
joins on it are one to one.

Totals over subtrees: within a band of ``height`` depths every node adds its values to its ancestors of
that band only. The band roots, with the totals of their bands, are a trie of their own whose depths
are divided by ``height``; it is rolled up in the same way, and its completed totals go to the
ancestors in the band above each root. So there are about log(depth) / log(height) rounds, and a node
makes at most ``height`` rows in each.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.workspace import written

LANES = 4
ROOT = ""
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
#: Identifiers joined into one row before a node's rows meet in one stream.
CHUNK = 4096


def running(rows: DataFrame, key: str, order: list, names: list[str]) -> DataFrame:
    """``rows`` with the columns ``names`` replaced by their running sums per key, in the given order.

    Rows are range-partitioned, so a large key spans many tasks; sums of a range's predecessors are
    carried in. The ranged rows are written, because both uses of a range number must agree.
    """
    ranged = written(rows.sparkSession, rows.repartitionByRange(key, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_range", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range", key).agg(*[F.sum(n).alias(n) for n in names])
    carry = totals.select("_range", key, *[F.sum(n).over(before).alias(f"_{n}") for n in names]).filter(F.col(f"_{names[0]}").isNotNull())
    others = [c for c in rows.columns if c not in names]
    summed = ranged.select("_range", *others, *[F.sum(n).over(inside).alias(n) for n in names])
    return summed.join(carry, ["_range", key], "left").select(
        *others, *[(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in names]
    )


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, i, turn_key, chars``: turns numbered from 1 in the order of ``turn``, null first.

    Turns with one number follow the digest of role and text. A null role or text is empty; rows
    without a conversation are in none.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)).alias("turn_key"),
        F.char_length(text).cast("long").alias("chars"),
        F.lit(1).cast("long").alias("i"),
    )
    return running(rows, "conv_id", ["turn", "turn_key"], ["i"]).drop("turn")


def shared_beginnings(turns: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first one of their block: ``(turns, lengths)`` for :func:`prefix_trie`.

    Conversation c starts with the first h turns of conversation c - c % block, as far as there are, and
    goes on with its own turns after its first h; h is the crc32 of its decimal id modulo ``most``.
    """
    turns = written(turns.sparkSession, turns, "turns")
    own = turns.groupBy("conv_id").agg(F.max("i").alias("n"))
    begin = F.sort_array(F.collect_list(F.struct("i", "turn_key", "chars")))  # fewer than ``most`` turns
    bases = turns.filter((F.col("i") < most) & (F.col("conv_id") % block == 0)).groupBy("conv_id").agg(begin.alias("begin"))
    taken = own.select(
        "*",
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % block).alias("base"),
    ).join(bases.withColumnRenamed("conv_id", "base"), "base", "left")
    taken = taken.withColumn("used", F.least("h", F.coalesce(F.size("begin"), F.lit(0))).cast("int"))
    taken = written(turns.sparkSession, taken, "beginnings")
    first = taken.filter("used > 0").select("conv_id", F.explode(F.slice("begin", F.lit(1), F.col("used"))).alias("t"))
    rest = turns.join(taken.select("conv_id", "h", "used"), "conv_id").filter("i > h")
    built = first.select("conv_id", F.col("t.i").alias("pos"), "t.turn_key", "t.chars").unionByName(
        rest.select("conv_id", (F.col("i") - F.col("h") + F.col("used")).alias("pos"), "turn_key", "chars")
    )
    return built, taken.select("conv_id", (F.col("used") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))


def _lane(digest, k):
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _key(sums):
    return F.md5(F.concat_ws(":", *sums))


def prefix_paths(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """``conv_id, depth, key, parent, chars``: every node on every conversation's way, the root included."""
    names = [f"s{k}" for k in range(LANES)]
    digest = F.md5(F.concat_ws(":", "pos", "turn_key"))
    rows = turns.select("conv_id", F.col("pos").cast("long").alias("pos"), digest.alias("digest"), "chars")
    rows = rows.select("*", *[_lane(F.col("digest"), k).alias(n) for k, n in enumerate(names)])
    # sums of 32-bit values: no overflow below 2^31 turns
    summed = running(rows, "conv_id", ["pos"], names)
    above = [F.col(n) - _lane(F.col("digest"), k) for k, n in enumerate(names)]
    paths = summed.select(
        "conv_id",
        F.col("pos").alias("depth"),
        _key([F.col(n) for n in names]).alias("key"),
        F.when(F.col("pos") == 1, F.lit(ROOT)).otherwise(_key(above)).alias("parent"),
        "chars",
    )
    root = lengths.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("chars"))
    return paths.unionByName(root)


def _joined_ids(batches):
    """Sorted (depth, key, conv_id) to rows of up to CHUNK ids, joined by commas."""
    names, held, at = ["depth", "key", "first", "ids"], [], None
    out = []

    def put():
        if held:
            out.append((at[0], at[1], held[0], ",".join(map(str, held))))
            held.clear()

    for batch in batches:
        for depth, key, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "key", "conv_id"))):
            if (depth, key) != at or len(held) >= CHUNK:
                put()
                at = (depth, key)
            held.append(conv)
        if len(out) >= CHUNK:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.string()))], names)
            out.clear()
    put()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.string()))], names)


def _digests(batches):
    """Sorted (depth, key, first, ids) to one digest per node, held as a running state only."""
    at, state, done = None, None, []

    def batch_of():
        rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.string(), pa.string()))], ["depth", "key", "ends_sha256"])
        done.clear()
        return rows

    for batch in batches:
        for depth, key, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "key", "ids"))):
            if (depth, key) != at:
                if state:
                    done.append((*at, state.hexdigest()))
                at, state = (depth, key), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(done) >= CHUNK:
            yield batch_of()
    if state:
        done.append((*at, state.hexdigest()))
        yield batch_of()


def end_digests(ends: DataFrame) -> DataFrame:
    """``depth, key, ends_sha256`` of ``ends (depth, key, conv_id)``.

    A digest is sequential: ids are sorted over ranges and joined into rows of thousands first, and the
    rows of one node are streamed through a running state, so memory is bounded.
    """
    joined = (
        ends.repartitionByRange("depth", "key", "conv_id")
        .sortWithinPartitions("depth", "key", "conv_id")
        .mapInArrow(_joined_ids, "depth long, key string, first long, ids string")
    )
    return (
        joined.repartition("depth", "key")
        .sortWithinPartitions("depth", "key", "first")
        .mapInArrow(_digests, "depth long, key string, ends_sha256 string")
    )


def subtree_totals(nodes: DataFrame, paths: DataFrame, values: list[str], height: int, deepest: int, step: int = 1) -> DataFrame:
    """``depth, key`` and the sums of ``values`` over the subtree of every node (its top included).

    ``nodes``: depth, key, conv_id (its representative) and the values; ``paths``: conv_id, depth, key.
    Both hold depths that are multiples of ``step``.
    """
    spark, span = nodes.sparkSession, step * height
    entry = F.struct("depth", "key", *values)
    marked = paths.join(nodes.select("conv_id", "depth", *values), ["conv_id", "depth"], "left")
    bands = marked.groupBy("conv_id", F.floor(F.col("depth") / span).cast("long").alias("band")).agg(
        F.sort_array(F.collect_list(entry)).alias("way"),  # at most ``height`` entries
        F.count(values[0]).alias("own"),
    )
    if span <= deepest:
        bands = written(spark, bands, "bands")

    def below(v):  # of the band's nodes that this conversation represents, those not above the entry
        part = F.slice("way", F.col("at") + 1, F.size("way"))
        return F.aggregate(part, F.lit(0).cast("long"), lambda total, e: total + F.coalesce(e[v], F.lit(0)))

    each = bands.filter("own > 0").select("way", F.posexplode("way").alias("at", "e"))
    totals = each.select("e.depth", "e.key", *[below(v).alias(v) for v in values]).groupBy("depth", "key").agg(*[F.sum(v).alias(v) for v in values])
    if span > deepest:
        return totals
    totals = written(spark, totals, "band-totals")
    on_top = F.col("depth") % span == 0
    roots = totals.filter(on_top).join(nodes.select("depth", "key", "conv_id"), ["depth", "key"])
    roots = written(spark, roots, "band-roots")
    complete = subtree_totals(roots, paths.filter(on_top), values, height, deepest, span)
    lifted = (
        roots.select("depth", "key", "conv_id")
        .filter("depth > 0")
        .join(complete, ["depth", "key"])
        .select("conv_id", (F.col("depth") / span - 1).cast("long").alias("band"), *[F.col(v).alias(f"all_{v}") for v in values])
        .join(bands.select("conv_id", "band", "way"), ["conv_id", "band"])
        .select(F.explode("way").alias("e"), *[f"all_{v}" for v in values])
        .select("e.depth", "e.key", *[F.col(f"all_{v}").alias(v) for v in values])
    )
    return totals.unionByName(lifted).groupBy("depth", "key").agg(*[F.sum(v).alias(v) for v in values])


def prefix_trie(turns: DataFrame, lengths: DataFrame, height: int = 16) -> DataFrame:
    """One row per node of the trie of ``turns (conv_id, pos, turn_key, chars)``, ``lengths (conv_id, length)``.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``, and the node's ``key``. Without conversations there is no node, not
    even the root.
    """
    spark = turns.sparkSession
    paths = written(spark, prefix_paths(turns, lengths), "paths")
    nodes = paths.groupBy("depth", "key").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"), F.max("parent").alias("parent")
    )
    nodes = written(spark, nodes, "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["depth", "key"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(spark, nodes, "trie")

    own = nodes.select(
        "depth", "key", "conv_id", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")
    )
    totals = subtree_totals(own, paths.select("conv_id", "depth", "key"), ["n_leaves", "saved_tokens"], height, deepest)
    ends = paths.join(lengths.select("conv_id", F.col("length").cast("long").alias("depth")), ["conv_id", "depth"]).select("depth", "key", "conv_id")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.drop("chars")
        .join(totals, ["depth", "key"])
        .join(end_digests(ends), ["depth", "key"], "left")
        .join(parents, ["depth", "parent"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"), "key",
        )
    )


def conversation_trie(conversations: DataFrame, height: int = 16) -> DataFrame:
    """:func:`prefix_trie` of conversations that share the beginnings of their block."""
    return prefix_trie(*shared_beginnings(ordered_turns(conversations)), height=height)

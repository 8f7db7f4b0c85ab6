"""Top rows, newest versions, samples and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.expressions import hash_bucket, hash_uniform


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of an order: each task keeps k rows, then k rows per task are merged."""
    return df.orderBy(*order).limit(k)


preview = top_k


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    ``max_by`` combines before the shuffle, so a key that holds most rows ships one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def latest_version(
    df: DataFrame, group: list[str], order: list[str], version_col: str | None = None, version=None
) -> DataFrame:
    """Newest version per group; an explicitly given version wins."""
    if version is not None:
        return df.filter(F.col(version_col) == version)
    return latest_per_key(df, group, order)


def prune_candidates(df: DataFrame, group: list[str], order: list[str], keep: int = 3) -> DataFrame:
    """Rows older than the newest ``keep`` of their group.

    The kept set is a limited ranking, which Spark cuts to ``keep`` rows per group and task before
    the shuffle; only its oldest entry per group goes into the join. A group of any size is thus
    never sorted whole in one task. ``order`` must be unique within a group.
    """
    ranked = Window.partitionBy(*group).orderBy(*[F.col(c).desc() for c in order])
    newest = (
        df.select(*group, *order)
        .withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= keep)
    )
    cutoff = newest.groupBy(*group).agg(F.min(F.struct(*order)).alias("_cutoff"))
    return df.join(cutoff, group).filter(F.struct(*order) < F.col("_cutoff")).drop("_cutoff")


def sample_fraction(df: DataFrame, fraction: float, ids: list[str], seed: int = 42) -> DataFrame:
    """Bernoulli sample: rows whose repeatable draw, a hash of seed and ids, is below ``fraction``.

    The choice doesn't depend on partitioning, so a retried task and a later run give the same rows.
    """
    return df.filter(hash_uniform([F.lit(seed), *ids]) < fraction)


def hash_split(df: DataFrame, id_cols: list[str], train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """Disjoint, repeatable train and test parts by the hash of an id.

    Splitting by an entity id keeps all rows of an entity on one side.
    """
    bucket = hash_bucket(id_cols, 10)
    return df.filter(bucket < train_tenths), df.filter(bucket >= train_tenths)

"""Frames the text operators start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.llm.arrays import NULL_ID
from riskloom.workspace import fresh_path


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``row_key`` (doc_id; a null id sorts last), ``text_key`` and ``text`` (null: empty), plus ``more``.

    The two keys name a row up to exact repetition: equal rows get equal results, so a join with one
    row per key pair returns every input row once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("row_key"),
        F.xxhash64(text).alias("text_key"),
        text.alias("text"),
        *more,
    )


def named(frame: DataFrame, key: str = "row_key", name: str = "doc_id") -> DataFrame:
    """The key as an id again."""
    return frame.withColumn(key, F.when(F.col(key) != NULL_ID, F.col(key))).withColumnRenamed(key, name)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark, frame: DataFrame, label: str) -> DataFrame:
    """Cut lineage like ``written``, compressed harder: for tables that hold text or hashes."""
    path = fresh_path(spark, label)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)

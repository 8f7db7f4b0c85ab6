"""From raw documents to a mixed training set: five stages, each of the rows its predecessor kept.

Every stage but the last returns the columns of ``documents``; each works on whole texts and on all
rows it is given. A row's decision is joined by its id and a hash of its text, so that rows with one
id are told apart and repeated rows share a decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm.contamination import contamination
from riskloom.llm.frames import NULL_ID, table
from riskloom.llm.line_dedup import deduped
from riskloom.llm.mixing import mix
from riskloom.llm.near_duplicates import near_duplicates
from riskloom.llm.quality import quality
from riskloom.workspace import fresh_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
DECISION = ["row_key", "text_key"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        *COLUMNS,
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("row_key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
    )


def _keep(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose keys are in ``decisions (row_key, text_key)``."""
    return _keyed(docs).join(decisions, DECISION, "left_semi").select(*COLUMNS)


def _keys(result: DataFrame) -> DataFrame:
    return result.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("row_key"), "text_key")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return _keep(docs, _keys(quality(docs).filter("kept")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share; ``n_chars`` follows the text."""
    rows = deduped(docs, F.struct(*COLUMNS).alias("doc"))
    changed = F.col("n_dropped") > 0
    return rows.select(
        "doc.doc_id",
        F.when(changed, F.col("kept_text")).otherwise(F.col("doc.text")).alias("text"),
        "doc.lang",
        "doc.source",
        F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col("doc.n_chars")).alias("n_chars"),
    )


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id, once.

    Documents without words are linked with nothing and stay. If several rows of a group have the
    smallest id, one of them stays.
    """
    rows = near_duplicates(docs).withColumn("row_key", F.coalesce("doc_id", F.lit(NULL_ID)))
    chosen = rows.groupBy("component").agg(F.min(F.struct("row_key", "text_key")).alias("at")).select("at.row_key", "at.text_key")
    kept = _keyed(docs).join(chosen, DECISION, "left_semi")
    # partitioned by these keys already: repeated rows become one without another shuffle
    return kept.groupBy(*DECISION).agg(F.first(F.struct(*COLUMNS)).alias("doc")).select("doc.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark."""
    return _keep(docs, _keys(contamination(docs, table(spark, sf_dir, "benchmark")).filter("not contaminated")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by calibrated probabilities: the columns of ``documents``, and how each row was weighed."""
    return mix(docs, *COLUMNS).select("doc.*", "topic", "n_tokens", "weight", "probability")


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: Neither the linked groups nor the raking has a form in SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

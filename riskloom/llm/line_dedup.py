"""Line dedup in DataFrame functions only.

Method (range-partitioned hashes): every line's key is hashed to 128 bits; hashes are
range-partitioned with a secondary sort by document and position, so that the rows of a hash stream
by in order and the first row of each document stands out. Each hash is dealt to ``salts`` ranges, so
that a line which a third of all documents hold is still shared by many tasks; what a range leaves is
one row. The result is not text but, for each document, the runs of lines that stay: a run-length
compressed keep bitmap, which :func:`apply_keep` turns into text.

Edge cases: a null or empty text is one empty line, which stays; a null id sorts after every other;
rows with the same id hold a line once between them; repeated rows get equal rows; an empty table
gives no rows; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.frames import keyed, named
from riskloom.workspace import written

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def keep_runs(n: Column, dropped: Column) -> Column:
    """Runs ``(start, size)`` of the lines 0..n-1 that are not in the sorted array ``dropped``."""
    k = F.size(dropped)
    runs = F.transform(
        F.sequence(F.lit(0), k),
        lambda j: F.struct(
            F.when(j == 0, F.lit(0)).otherwise(F.get(dropped, j - 1) + 1).alias("start"),
            (F.coalesce(F.get(dropped, j), n) - F.when(j == 0, F.lit(0)).otherwise(F.get(dropped, j - 1) + 1)).alias("size"),
        ),
    )
    return F.filter(runs, lambda r: r["size"] > 0)


def line_keeps(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, salts: int = 16) -> DataFrame:
    """``row_key, text_key, keep`` of the documents that lose lines.

    A key of ``least_chars`` or more code points that ``least_docs`` or more documents hold stays only
    in the largest doc_id that holds it.
    """
    lines = (
        keyed(docs)
        .select("row_key", "text_key", F.posexplode(F.split("text", "\n")).alias("at", "line"))
        .withColumn("line", line_key(F.col("line")))
        .filter(F.char_length("line") >= least_chars)
        .select(
            "row_key", "text_key", "at",
            F.xxhash64("line").alias("high"),
            F.xxhash64(F.lit(1), "line", F.lit("line")).alias("low"),
            F.pmod(F.xxhash64("row_key"), F.lit(salts)).cast("int").alias("salt"),
        )
    )
    hashes = ["high", "low"]
    ranged = lines.select(*hashes, "salt", "row_key", "at").repartitionByRange(*hashes, "salt")
    stream = Window.partitionBy(*hashes, "salt").orderBy(F.desc("row_key"), "at")
    firsts = ranged.withColumn("before", F.lag("row_key").over(stream)).filter(
        F.col("before").isNull() | (F.col("before") != F.col("row_key"))
    )
    common = (
        firsts.groupBy(*hashes, "salt")
        .agg(F.count("*").alias("holders"), F.max("row_key").alias("last"))
        .groupBy(*hashes)
        .agg(F.sum("holders").alias("holders"), F.max("last").alias("last"))
        .filter(F.col("holders") >= least_docs)
        .select(*hashes, "last")
    )
    # written, so that both sides of the join come straight from a shuffle and a hot hash can be split
    common = written(docs.sparkSession, common, "common-lines")
    return (
        lines.drop("salt").join(common, hashes)
        .filter(F.col("row_key") != F.col("last"))
        .groupBy("row_key", "text_key")
        .agg(F.array_sort(F.collect_set("at")).alias("dropped"))
    )


def deduped(docs: DataFrame, *more: str, **rule) -> DataFrame:
    """``row_key``, ``n_lines``, ``n_dropped``, ``keep`` (runs of lines that stay) and ``kept_text``, plus ``more``."""
    texts = keyed(docs, *more)
    keeps = line_keeps(docs, **rule)
    lines = F.split("text", "\n")
    joined = texts.join(keeps, ["row_key", "text_key"], "left").withColumn("n_lines", F.size(lines))
    joined = joined.withColumn("keep", F.when(F.col("dropped").isNotNull(), keep_runs(F.col("n_lines"), F.col("dropped"))))
    return joined.withColumns(
        {
            "n_dropped": F.when(F.col("dropped").isNull(), F.lit(0)).otherwise(F.size("dropped")),
            "kept_text": F.when(F.col("dropped").isNull(), F.col("text")).otherwise(apply_keep(lines, F.col("keep"))),
        }
    ).drop("dropped", "text_key")


def apply_keep(lines: Column, keep: Column) -> Column:
    return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["size"]))), "\n")


def line_dedup(docs: DataFrame, **rule) -> DataFrame:
    """One row per document: ``n_lines``, ``n_dropped``, ``keep`` and a digest of what stays."""
    return named(
        deduped(docs, **rule).select(
            "row_key",
            F.col("n_lines").cast("long").alias("n_lines"),
            F.col("n_dropped").cast("long").alias("n_dropped"),
            F.sha2(F.col("kept_text"), 256).alias("kept_sha256"),
            F.when(F.col("keep").isNotNull(), F.array_join(F.transform("keep", lambda r: F.concat_ws("+", r["start"], r["size"])), ",")).alias("keep_runs"),
        )
    )

"""Reading, writing and reconciling named tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, location: str) -> DataFrame:
    """A parquet path, or the name of a catalog table or view."""
    return spark.read.parquet(location) if "/" in location else spark.table(location)


def conform(df: DataFrame, schema: dict[str, str], defaults: dict[str, Column] | None = None) -> DataFrame:
    """Enforce a typed schema; columns named in ``defaults`` are filled when absent or NULL."""
    defaults = defaults or {}
    present = {c.lower() for c in df.columns}

    def typed(name: str, kind: str) -> Column:
        if name.lower() in present:
            value = F.col(name).cast(kind)
            return F.coalesce(value, defaults[name].cast(kind)) if name in defaults else value
        if name in defaults:
            return defaults[name].cast(kind)
        raise ValueError(f"column {name!r} is missing and has no default")

    wanted = {**schema, **{n: None for n in defaults if n not in schema}}
    return df.select(
        *[(typed(n, k) if k else defaults[n]).alias(n) for n, k in wanted.items()]
    )


def normalise_columns(df: DataFrame, upper: bool = False) -> DataFrame:
    return df.toDF(*[c.upper() if upper else c.lower() for c in df.columns])


def align_schema(df: DataFrame, target: DataFrame) -> DataFrame:
    """Keep the target's columns, in its order and types; reads schemas only."""
    have = {c.lower() for c in df.columns}
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema if f.name.lower() in have]
    )


def project_cast(df: DataFrame, types: dict[str, str], lenient: bool = False) -> DataFrame:
    """Columns cast by role; ``lenient`` turns a bad value into NULL instead of an error."""
    return df.select(
        *[(F.col(n).try_cast(k) if lenient else F.col(n).cast(k)).alias(n) for n, k in types.items()]
    )


def fill_missing(df: DataFrame, numeric: float = 0, text: str = "Unknown") -> DataFrame:
    """Fill NULLs by column kind, each kind in its own right."""
    return df.fillna(numeric).fillna(text)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write parquet and return the row count of what was written (a footer-only scan)."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def append_by_name(df: DataFrame, path: str) -> None:
    """Append to a table, matching columns by name; absent ones become NULL."""
    target = df.sparkSession.read.parquet(path)
    known = {c.lower() for c in target.columns}
    extra = [c for c in df.columns if c.lower() not in known]
    if extra:
        raise ValueError(f"columns {extra} are not in the target table")
    have = {c.lower() for c in df.columns}
    matched = df.select(
        *[
            (F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )
    matched.write.mode("append").parquet(path)


def create_table_as(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """CREATE TABLE AS in the session catalog; ``path`` makes it an external table."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def define_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keyed merge: the updates' newest row where the key matches, else the old row.

    Columns the updates lack keep the target's value (NULL for a new key). Rows without a full key
    match nothing: those of both sides stay as they are. Both sides are combined by one
    pre-aggregated grouping, so repeated updates of a key collapse before the shuffle.
    """
    have = {c.lower() for c in updates.columns}
    kept = [c for c in target.columns if c.lower() not in have]
    sided = target.withColumn("_from", F.lit(0)).unionByName(
        updates.withColumn("_from", F.lit(1)), allowMissingColumns=True
    )
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rest = [c for c in sided.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct("_from", *order)).alias("_row")
    old = F.max_by(F.struct(*kept), F.when(F.col("_from") == 0, F.struct(*order))) if kept else F.lit(None)
    merged = sided.filter(whole).groupBy(*keys).agg(newest, old.alias("_old"))
    columns = [c for c in sided.columns if c != "_from"]
    picked = [F.col(c) if c in keys else F.col("_old")[c].alias(c) if c in kept else F.col("_row")[c].alias(c) for c in columns]
    return merged.select(*picked).unionByName(sided.filter(~whole).select(*columns))


def lookup(wanted: DataFrame, state: DataFrame, keys: list[str], value: str, default) -> DataFrame:
    """Keyed read with a default. ``state`` holds one row per key."""
    found = state.select(*keys, value)
    return wanted.join(found, keys, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per named frame with its row count."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)

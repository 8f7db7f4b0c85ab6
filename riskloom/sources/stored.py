"""Small stored tables that change: keyed rows, and tables kept in parts.

Both write new folders first and name them last, so a reader sees the old state or the new one, and
a writer that repeats a numbered step replaces its own result. The folders before the previous
state are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.paths import numbered, remove
from riskloom.sources.tables import lookup, upsert


class KeyedTable:
    """One row per key: ``merge`` writes a new version, ``read`` gives the newest complete one."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str]):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), list(keys), list(order)

    def versions(self) -> list[int]:
        return numbered(self.spark, self.path, "version")

    def read(self, before: int | None = None) -> DataFrame | None:
        """The current rows, or those before a version; None before the first write."""
        found = [v for v in self.versions() if before is None or v < before]
        return self.spark.read.parquet(f"{self.path}/version={found[-1]}") if found else None

    def merge(self, updates: DataFrame, version: int | None = None) -> DataFrame:
        """Set the updates' rows. A given version number makes the step repeatable."""
        known = self.versions()
        version = version if version is not None else (known[-1] + 1 if known else 0)
        old = self.read(before=version)
        target = old if old is not None else updates.limit(0)
        upsert(target, updates, self.keys, self.order).write.mode("overwrite").parquet(f"{self.path}/version={version}")
        for stale in [v for v in known if v < version][:-1]:
            remove(self.spark, f"{self.path}/version={stale}")
        return self.read()

    def get(self, wanted: DataFrame, value: str, default) -> DataFrame:
        """Keyed read with a default."""
        current = self.read()
        if current is None:
            return wanted.withColumn(value, F.lit(default))
        return lookup(wanted, current, self.keys, value, default)


class PartTable:
    """A table in parts (windows of time), of which a step replaces those it names and no others.

    ``batch_id=<n>`` folders hold parts, the list of the newest step says which folder holds which
    part. A step writes only the parts that changed.
    """

    def __init__(self, spark: SparkSession, path: str, part: str):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part

    def _list(self, before: int | None = None) -> tuple[int | None, DataFrame | None]:
        found = [n for n in numbered(self.spark, f"{self.path}/list", "step") if before is None or n < before]
        return (found[-1], self.spark.read.parquet(f"{self.path}/list/step={found[-1]}")) if found else (None, None)

    def read(self, before: int | None = None) -> DataFrame | None:
        _, parts = self._list(before)
        if parts is None:
            return None
        rows = self.spark.read.option("basePath", f"{self.path}/data").parquet(f"{self.path}/data")
        return rows.join(parts, [self.part, "batch_id"], "left_semi").drop("batch_id")

    def replace(self, rows: DataFrame, step: int) -> None:
        """Put whole parts; repeatable per step."""
        last, old = self._list(before=step)
        rows.write.mode("overwrite").parquet(f"{self.path}/data/batch_id={step}")
        written = self.spark.read.schema(rows.schema).parquet(f"{self.path}/data/batch_id={step}")
        parts = written.select(self.part).distinct().withColumn("batch_id", F.lit(step))
        if old is not None:
            parts = parts.unionByName(old.join(parts.select(self.part), self.part, "left_anti"))
        parts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/list/step={step}")
        if last is not None:  # the previous state stays for its readers and for a repeated step
            used = {r[0] for r in self._list()[1].unionByName(old).select("batch_id").distinct().collect()}
            for n in numbered(self.spark, f"{self.path}/data", "batch_id"):
                if n < step and n not in used:
                    remove(self.spark, f"{self.path}/data/batch_id={n}")
            for n in numbered(self.spark, f"{self.path}/list", "step"):
                if n < last:
                    remove(self.spark, f"{self.path}/list/step={n}")

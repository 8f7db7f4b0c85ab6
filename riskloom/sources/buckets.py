"""A keyed table in hash buckets: base and delta files, and numbered commits of which one writer wins.

A row's bucket is a hash of its key. A merge writes the updates' newest row per key as delta files of the
buckets they fall into; a bucket with more than ``max_deltas`` deltas is written anew in the same commit.
Buckets without updates are not touched. The state of the table is a small manifest per commit, which says
which folders hold each bucket. It is created without overwriting: of two writers of one number the
second starts again from the first one's state. Reading takes the newest manifest and combines at most
``max_deltas + 1`` rows per key.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.selection import latest_per_key
from riskloom.sources.paths import child_names, create_text, read_text, remove

BUCKET = "_bucket"


class BucketTable:
    """One row per key, the one greatest by ``order``; late rows never win.

    ``order`` columns take part in the row. Rows without a full key belong to no key and are refused.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], order: list[str], buckets: int = 64, max_deltas: int = 4, keep: int = 8
    ):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), list(keys), list(order)
        self.buckets, self.max_deltas, self.keep = buckets, max_deltas, keep

    # -- commits

    def commits(self) -> list[int]:
        return sorted(int(n) for n in child_names(self.spark, f"{self.path}/commits") if n.isdigit())

    def manifest(self, commit: int | None = None) -> dict | None:
        """The state after a commit; None stands for the newest one."""
        if commit is None:
            known = self.commits()
            if not known:
                return None
            commit = known[-1]
        return json.loads(read_text(self.spark, f"{self.path}/commits/{commit}"))

    def _bucketed(self, rows: DataFrame, buckets: int) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.hash(*self.keys), F.lit(buckets)))

    def _files(self, manifest: dict, buckets=None) -> DataFrame | None:
        """All rows of some buckets: bases and deltas."""
        chosen = manifest["files"] if buckets is None else {str(b): manifest["files"].get(str(b), []) for b in buckets}
        paths = [f"{self.path}/data/{folder}/{BUCKET}={b}" for b, folders in chosen.items() for folder in folders]
        return self.spark.read.schema(manifest["schema"]).parquet(*paths) if paths else None

    # -- reading

    def read(self) -> DataFrame | None:
        """The current rows; None before the first merge."""
        manifest = self.manifest()
        if manifest is None:
            return None
        rows = self._files(manifest)
        return latest_per_key(rows, self.keys, self.order) if rows is not None else self.spark.createDataFrame([], manifest["schema"])

    def get(self, wanted: DataFrame) -> DataFrame:
        """The current rows of some keys, from their buckets alone."""
        manifest = self.manifest()
        if manifest is None:
            raise LookupError(f"{self.path} was never written")
        asked = self._bucketed(wanted.select(*self.keys).distinct(), manifest["buckets"])
        touched = [r[0] for r in asked.select(BUCKET).distinct().collect()]  # at most one per bucket
        rows = self._files(manifest, touched)
        if rows is None:
            return self.spark.createDataFrame([], manifest["schema"])
        return latest_per_key(rows.join(asked.select(*self.keys), self.keys, "left_semi"), self.keys, self.order)

    # -- writing

    def merge(self, updates: DataFrame, writer: str | None = None, step: int | None = None) -> int:
        """Set the newest row of each key; returns the number of the commit that holds it.

        ``writer`` and ``step`` make a numbered step repeatable: a step that is not above the writer's last
        one in the table changes nothing.
        """
        if updates.filter(F.concat(*[F.col(k).cast("string") for k in self.keys]).isNull()).limit(1).count():
            raise ValueError(f"rows without a full key {self.keys}")
        folder = None
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in updates.schema)
        while True:
            known = self.commits()
            old = self.manifest(known[-1]) if known else {"files": {}, "applied": {}, "buckets": self.buckets, "schema": None}
            if old["schema"] not in (None, schema):
                raise ValueError(f"the table holds {old['schema']}, not {schema}")
            if writer is not None and old["applied"].get(writer, -1) >= step:
                return known[-1]
            if folder is None:
                # deltas don't depend on the table's state: written once, however many tries the commit takes
                folder = f"delta-{uuid.uuid4().hex[:12]}"
                fresh = self._bucketed(latest_per_key(updates, self.keys, self.order), old["buckets"])
                fresh.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{folder}")
            number = known[-1] + 1 if known else 0
            if create_text(self.spark, f"{self.path}/commits/{number}", json.dumps(self._next(old, folder, schema, writer, step))):
                self._clean()
                return number

    def _next(self, old: dict, folder: str, schema: str, writer: str | None, step: int | None) -> dict:
        """The state with a delta added, and with the buckets that have many written anew."""
        touched = [n.split("=", 1)[1] for n in child_names(self.spark, f"{self.path}/data/{folder}") if n.startswith(f"{BUCKET}=")]
        files = {b: list(f) for b, f in old["files"].items()}
        for b in touched:
            files.setdefault(b, []).append(folder)
        state = {"files": files, "schema": schema, "buckets": old["buckets"], "applied": dict(old["applied"])}
        if writer is not None:
            state["applied"][writer] = step
        crowded = [b for b in touched if len(files[b]) > self.max_deltas + 1]
        if crowded:
            base = f"base-{uuid.uuid4().hex[:12]}"
            whole = self._bucketed(latest_per_key(self._files(state, crowded), self.keys, self.order), state["buckets"])
            whole.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{base}")
            for b in crowded:
                files[b] = [base]
        return state

    def _clean(self) -> None:
        """Delete commits before the last ``keep``, and the folders that only they name.

        Readers of a kept commit are not disturbed. Folders no commit names may belong to a writer at work.
        """
        known = self.commits()
        stale, kept = known[: -self.keep], known[-self.keep :]
        if not stale:
            return
        used = {f for n in kept for folders in self.manifest(n)["files"].values() for f in folders}
        for n in stale:
            for folder in {f for folders in self.manifest(n)["files"].values() for f in folders} - used:
                remove(self.spark, f"{self.path}/data/{folder}")
            remove(self.spark, f"{self.path}/commits/{n}")

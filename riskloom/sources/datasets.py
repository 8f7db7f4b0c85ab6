"""Versioned dataset snapshots and the feature store.

A snapshot is a folder ``<root>/<name>/version=<v>`` that is written once and never changed; it
counts as present when its success marker is there, so a broken write is not picked up.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.joins import FeatureView, retrieve_features
from riskloom.operators.selection import latest_per_key
from riskloom.sources.buckets import BucketTable
from riskloom.sources.layout import TimeLayout
from riskloom.sources.paths import child_names, create_text, exists, read_text
from riskloom.workspace import small_frame


def _folder(root: str, name: str, version: str) -> str:
    return f"{root}/{name}/version={version}"


def dataset_versions(spark: SparkSession, root: str, name: str) -> list[str]:
    found = [n.split("=", 1)[1] for n in child_names(spark, f"{root}/{name}") if n.startswith("version=")]
    return sorted(v for v in found if exists(spark, _folder(root, name, v) + "/_SUCCESS"))


def write_dataset_version(df: DataFrame, root: str, name: str, version: str) -> None:
    """Write an immutable snapshot; a version that exists is an error."""
    df.write.mode("errorifexists").parquet(_folder(root, name, version))


def read_dataset_version(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """Read a snapshot; None means the newest complete version."""
    if version is None:
        versions = dataset_versions(spark, root, name)
        if not versions:
            raise LookupError(f"dataset {name!r} has no complete version")
        version = versions[-1]
    parts = [*_grown_from(spark, root, name, version).get("parts", []), version]
    return spark.read.parquet(*[_folder(root, name, v) for v in parts])


def _grown_from(spark: SparkSession, root: str, name: str, version: str) -> dict:
    """Of a version that adds to others: their names, and the newest spine time in it."""
    path = f"{_folder(root, name, version)}/_grown_from"
    return json.loads(read_text(spark, path)) if exists(spark, path) else {}


_FIRST = "batch_id=-1"  # what create_view wrote; refreshes add batch_id=0, 1, ...
_ENTITY_SCHEMA = "entity string, join_keys array<string>, description string"
_VIEW_SCHEMA = (
    "view string, version string, entity string, ts_column string, tie_break array<string>, "
    "refresh string, description string"
)


class FeatureStore:
    """Entities and versioned feature views below one folder of the shared storage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- catalog: a few rows per registration, kept as append-only parquet

    def _append(self, table: str, row: tuple, schema: str) -> None:
        one = small_frame(self.spark, [row], schema)
        one.coalesce(1).write.mode("append").parquet(f"{self.root}/_catalog/{table}")

    def _catalog(self, table: str, schema: str) -> DataFrame:
        path = f"{self.root}/_catalog/{table}"
        if not exists(self.spark, path):
            return small_frame(self.spark, [], schema)
        return self.spark.read.schema(schema).parquet(path)

    def entities(self) -> DataFrame:
        return self._catalog("entities", _ENTITY_SCHEMA)

    def views(self) -> DataFrame:
        return self._catalog("views", _VIEW_SCHEMA)

    def create_entity(self, name: str, join_keys: list[str], description: str = "") -> None:
        """Register an entity; one of that name that exists stays as it is."""
        if self.entities().filter(F.col("entity") == name).isEmpty():
            self._append("entities", (name, list(join_keys), description), _ENTITY_SCHEMA)

    def join_keys(self, entity: str) -> list[str]:
        found = self.entities().filter(F.col("entity") == entity).head()
        if found is None:
            raise LookupError(f"unknown entity {entity!r}")
        return list(found["join_keys"])

    def create_view(
        self,
        name: str,
        df: DataFrame,
        entity: str,
        version: str = "v1",
        ts_column: str = "ts",
        tie_break: list[str] = (),
        refresh: str = "1 minute",
        description: str = "",
        replace: bool = False,
    ) -> DataFrame:
        """Materialise a view under (name, version) and return it.

        One that exists is returned unchanged, so a repeated run does no work; a changed rule
        needs a new version, or ``replace``: ``df`` then becomes the whole view, in a new folder, and
        neither the old rows nor those of earlier refreshes are in it any more.
        """
        current = self._current(name, version)
        if replace or current is None:
            # by path, not in place: readers of the old folder are not disturbed
            df.write.mode("overwrite").parquet(f"{self._view_path(name, version)}/write={0 if current is None else current + 1}/{_FIRST}")
        known = (F.col("view") == name) & (F.col("version") == version)
        if self.views().filter(known).isEmpty():
            row = (name, version, entity, ts_column, list(tie_break), refresh, description)
            self._append("views", row, _VIEW_SCHEMA)
        return self.read_view(name, version)

    def _view_path(self, name: str, version: str) -> str:
        return _folder(f"{self.root}/views", name, version)

    def _current(self, name: str, version: str) -> int | None:
        """Number of the newest complete write of a view."""
        path = self._view_path(name, version)
        found = [int(n.split("=", 1)[1]) for n in child_names(self.spark, path) if n.startswith("write=")]
        return next((n for n in sorted(found, reverse=True) if exists(self.spark, f"{path}/write={n}/{_FIRST}/_SUCCESS")), None)

    def _current_path(self, name: str, version: str) -> str:
        current = self._current(name, version)
        if current is None:
            raise LookupError(f"view {name}/{version} was never written")
        return f"{self._view_path(name, version)}/write={current}"

    def read_view(self, name: str, version: str = "v1") -> DataFrame:
        return self.spark.read.parquet(self._current_path(name, version)).drop("batch_id")

    def refresh_view(self, name: str, version: str, arrived: DataFrame, refresh: str | None = "1 minute"):
        """Keep a view up to date from a stream of its rows; returns the running query.

        Each micro-batch is a folder of its own beside the first write and replaces itself when
        it is retried. ``refresh=None`` takes in what is there and ends.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self._current_path(name, version)}/batch_id={batch_id}")
            table = self.online_table(name, version)
            if table.manifest() is not None:
                table.merge(batch.dropna(subset=table.keys), "refresh", batch_id)

        writer = arrived.writeStream.foreachBatch(write).option(
            "checkpointLocation", f"{self.root}/_refresh/{name}/{version}"
        )
        writer = writer.trigger(processingTime=refresh) if refresh else writer.trigger(availableNow=True)
        return writer.start()

    def feature_view(self, name: str, version: str = "v1", prefix: str = "") -> FeatureView:
        """A registered view as an input of the point-in-time join."""
        row = self.views().filter((F.col("view") == name) & (F.col("version") == version)).head()
        if row is None:
            raise LookupError(f"unknown view {name}/{version}")
        frame, keys = self.read_view(name, version), self.join_keys(row["entity"])
        values = [c for c in frame.columns if c not in keys and c != row["ts_column"]]
        return FeatureView(frame, row["ts_column"], values, list(row["tie_break"]), prefix)

    def online_table(self, name: str, version: str = "v1") -> BucketTable:
        """The maintained table of a view's current rows: one of its own for every whole write of the view."""
        row = self.views().filter((F.col("view") == name) & (F.col("version") == version)).head()
        if row is None:
            raise LookupError(f"unknown view {name}/{version}")
        path = f"{_folder(f'{self.root}/online', name, version)}/write={self._current(name, version)}"
        return BucketTable(self.spark, path, self.join_keys(row["entity"]), [row["ts_column"], *row["tie_break"]])

    def maintain_online(self, name: str, version: str = "v1") -> None:
        """Keep the current row per entity from now on: refreshes merge into it what they bring.

        The rows there are by now are merged once. A view without this is read whole by ``online_features``.
        """
        table = self.online_table(name, version)
        if table.manifest() is None:
            table.merge(self.read_view(name, version).dropna(subset=table.keys))

    def online_features(self, name: str, version: str = "v1") -> DataFrame:
        """The current row per entity of a registered view, without its history where it is maintained."""
        table = self.online_table(name, version)
        if table.manifest() is not None:
            return table.read()
        return latest_per_key(self.read_view(name, version), table.keys, table.order)

    def compact_view(self, name: str, version: str = "v1") -> int:
        """Put the refreshes of a view into one folder; returns how many folders that leaves out.

        The newest batch stays a folder of its own, so that its stream may repeat it. The old folders stay
        for their readers until ``drop_old_writes``. Not to be run while a batch is being written.
        """
        current = self._current(name, version)
        path = f"{self._view_path(name, version)}/write={current}"
        batches = sorted(int(n.split("=", 1)[1]) for n in child_names(self.spark, path) if n.startswith("batch_id="))
        settled, newest = (batches[:-1], batches[-1]) if len(batches) > 1 else (batches, None)
        if len(settled) < 2:
            return 0
        table = self.online_table(name, version)
        after = f"{self._view_path(name, version)}/write={current + 1}"
        if newest is not None:
            self.spark.read.parquet(f"{path}/batch_id={newest}").write.mode("overwrite").parquet(f"{after}/batch_id={newest}")
        if table.manifest() is not None:
            later = BucketTable(self.spark, table.path.rsplit("=", 1)[0] + f"={current + 1}", table.keys, table.order)
            later.merge(table.read(), "refresh", table.manifest()["applied"].get("refresh", -1))
        old = self.spark.read.parquet(*[f"{path}/batch_id={b}" for b in settled])
        old.write.mode("overwrite").parquet(f"{after}/{_FIRST}")  # last: its marker makes the new write current
        return len(settled) - 1

    def generate_dataset(
        self, spine: DataFrame, views: list[FeatureView], keys: list[str], spine_ts: str, name: str, version: str
    ) -> DataFrame:
        """Point-in-time features for a spine, frozen as a dataset version."""
        joined = retrieve_features(spine, views, keys, spine_ts)
        write_dataset_version(joined, f"{self.root}/datasets", name, version)
        return read_dataset_version(self.spark, f"{self.root}/datasets", name, version)

    # -- layouts: views bucketed for retrieval, datasets that grow

    def layout(self, name: str, version: str = "v1", seconds: int = 30 * 86400, buckets: int = 64) -> TimeLayout:
        """A registered view bucketed by key and slice of time; laid out on first use."""
        view = self.feature_view(name, version)
        row = self.views().filter((F.col("view") == name) & (F.col("version") == version)).head()
        root = f"{self.root}/layouts/{version}/write={self._current(name, version)}"
        out = TimeLayout(
            self.spark, root, name, self.join_keys(row["entity"]), view.ts, view.values, view.tie_break, seconds, buckets
        )
        if not exists(self.spark, f"{root}/{name}/newest/_SUCCESS"):
            out.append(view.frame)
        return out

    def extend_dataset(
        self, spine: DataFrame, layouts: dict[str, TimeLayout], spine_ts: str, name: str, version: str
    ) -> DataFrame:
        """A new dataset version that computes only the spine rows after the newest version's last one.

        ``layouts`` by the prefix of their values. The version holds its own rows and names the earlier
        versions it adds to; reading it gives all of them. Spine rows that arrive with a time not above that of the
        newest version belong to no later one: they need a version from scratch.
        """
        root = f"{self.root}/datasets"
        known = dataset_versions(self.spark, root, name)
        before = _grown_from(self.spark, root, name, known[-1]) if known else {}
        if known and not before:
            raise ValueError(f"{name}/{known[-1]} was not made to be extended")
        kind = dict(spine.dtypes)[spine_ts]
        until = before.get("until")  # None: no version has rows with a time yet
        fresh = spine if until is None else spine.filter(F.col(spine_ts) > F.lit(until).cast(kind))
        joined = fresh
        for prefix, layout in layouts.items():
            joined = layout.retrieve(joined, spine_ts, prefix)
        until = fresh.agg(F.max(spine_ts).cast("string")).first()[0] or before.get("until")
        grown = {"parts": [*before.get("parts", []), *known[-1:]], "until": until}
        write_dataset_version(joined, root, name, version)
        create_text(self.spark, f"{_folder(root, name, version)}/_grown_from", json.dumps(grown))
        return read_dataset_version(self.spark, root, name, version)

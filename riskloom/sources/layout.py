"""Feature views laid out for point-in-time retrieval: bucketed by key and slice of time.

The time axis is cut into slices of equal length. Rows are stored in a bucketed table by (key, slice), so
a key of any size spans many buckets, and beside it, per (key, slice), the newest row. A spine row finds its
feature row within its slice, or else takes the newest row of the key's last slice before. The stored
rows are read in the partitioning they were written in: only the spine is shuffled.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.operators.selection import latest_per_key
from riskloom.sources.paths import exists

SLICE = "_slice"


class TimeLayout:
    """A bucketed view ``name`` below ``root``. ``seconds`` is the length of a slice.

    ``values`` are the columns a retrieval returns; ties at one time are broken by ``tie_break`` and then by all values
    that can be ordered, the greatest wins, so values that are maps need a ``tie_break``.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str,
        keys: list[str],
        ts: str,
        values: list[str],
        tie_break: list[str] = (),
        seconds: int = 30 * 86400,
        buckets: int = 64,
    ):
        self.spark, self.root, self.name = spark, root.rstrip("/"), name
        self.keys, self.ts, self.values, self.tie_break = list(keys), ts, list(values), list(tie_break)
        self.seconds, self.buckets = seconds, buckets

    # -- writing

    def _slice(self, ts: str, kind: str) -> Column:
        # the same in every session: seconds of a timestamp without time zone don't depend on one
        seconds = F.unix_timestamp(ts) if kind == "timestamp" else F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01', CAST(`{ts}` AS TIMESTAMP_NTZ))")
        return F.floor(seconds / self.seconds).cast("long")

    def _order(self, kinds: dict) -> list[str]:
        rest = [c for c in self.values if c not in self.tie_break and "map<" not in kinds[c]]
        if not self.tie_break and len(rest) < len(self.values):
            raise ValueError("values that are maps have no order: give a tie_break")
        return [self.ts, *self.tie_break, *rest]

    def append(self, rows: DataFrame) -> None:
        """Add rows to the view, of any time. Rows without a full key or time are never found and left out."""
        columns = [*self.keys, self.ts, *dict.fromkeys([*self.tie_break, *self.values])]
        whole = rows.select(*columns).dropna(subset=[*self.keys, self.ts]).withColumn(SLICE, self._slice(self.ts, dict(rows.dtypes)[self.ts]))
        order = self._order(dict(whole.dtypes))
        newest = latest_per_key(whole, [*self.keys, SLICE], order)
        for part, frame, within in (("rows", whole, [self.ts]), ("newest", newest, [SLICE])):
            spread = [*self.keys, SLICE] if part == "rows" else self.keys
            # bucketed by the same columns first: one file per bucket
            (
                frame.repartition(self.buckets, *spread)
                .write.format("parquet")
                .bucketBy(self.buckets, *spread)
                .sortBy(*dict.fromkeys([*spread, *within]))
                .option("path", f"{self.root}/{self.name}/{part}")
                .mode("append")
                .saveAsTable(self._table(part))
            )

    def _table(self, part: str) -> str:
        """The catalog's name of a part; a part written by an earlier session is made known again."""
        path = f"{self.root}/{self.name}/{part}"
        name = f"{self.name}_{part}_{hashlib.md5(path.encode()).hexdigest()[:8]}"
        if not self.spark.catalog.tableExists(name) and exists(self.spark, path):
            spread = [*self.keys, SLICE] if part == "rows" else self.keys
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema)
            quoted = ", ".join(f"`{c}`" for c in spread)
            within = ", ".join(f"`{c}`" for c in dict.fromkeys([*spread, self.ts if part == "rows" else SLICE]))
            self.spark.sql(
                f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY ({quoted}) SORTED BY ({within}) "
                f"INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
        return name

    def rows(self) -> DataFrame:
        return self.spark.table(self._table("rows"))

    # -- retrieval

    def retrieve(self, spine: DataFrame, spine_ts: str, prefix: str = "") -> DataFrame:
        """``spine`` with the newest row of the view not after ``spine_ts``, as the as-of join gives it.

        Spine rows without key or time, or without an earlier row, get NULLs.
        """
        twice = {n.lower() for n in spine.columns} & {f"{prefix}{v}".lower() for v in self.values}
        if twice:
            raise ValueError(f"columns {sorted(twice)} occur twice in the result: give the view a prefix")
        rows, kinds = self.rows(), dict(self.rows().dtypes)
        order = self._order(kinds)
        whole = " AND ".join(f"`{c}` IS NOT NULL" for c in [*self.keys, spine_ts])
        if dict(spine.dtypes)[spine_ts] != kinds[self.ts]:
            raise ValueError(f"{spine_ts} is a {dict(spine.dtypes)[spine_ts]}, the view's time a {kinds[self.ts]}")
        asked = spine.filter(whole).withColumn(SLICE, self._slice(spine_ts, kinds[self.ts]))
        lost = spine.filter(f"NOT ({whole})")
        value = rows.select(F.struct(*self.values).alias("v")).schema["v"].dataType
        # the spine first: a union keeps the partitioning of its first side when the others have it too
        ours = asked.repartition(self.buckets, *self.keys, SLICE).select(
            *self.keys, SLICE, F.col(spine_ts).alias("_t"), F.lit(1).alias("_side"), F.struct(*spine.columns).alias("_spine"),
            F.lit(None).cast(value).alias("_v"), *[F.lit(None).cast(kinds[c]).alias(f"_o{i}") for i, c in enumerate(order[1:])],
        )
        theirs = rows.select(
            *self.keys, SLICE, F.col(self.ts).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(ours.schema["_spine"].dataType).alias("_spine"),
            F.struct(*self.values).alias("_v"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order[1:])],
        )
        theirs = self._only(theirs, asked)
        ties = [f"_o{i}" for i in range(len(order) - 1)]
        so_far = Window.partitionBy(*self.keys, SLICE).orderBy("_t", "_side", *ties).rowsBetween(Window.unboundedPreceding, 0)
        within = (
            ours.unionByName(theirs)
            .select(*self.keys, SLICE, "_side", "_spine", F.last("_v", ignorenulls=True).over(so_far).alias("_v"))
            .filter("_side = 1")
        )
        found = within.join(self._before(asked, value), [*self.keys, SLICE], "left")
        picked = F.coalesce("_v", "_before")
        out = [picked.getField(c).alias(f"{prefix}{c}") for c in self.values]
        nulls = [F.lit(None).cast(kinds[c]).alias(f"{prefix}{c}") for c in self.values]
        return found.select("_spine.*", *out).unionByName(lost.select("*", *nulls))

    def _only(self, rows: DataFrame, asked: DataFrame) -> DataFrame:
        """The slices that hold spine rows; earlier ones are known by their newest rows."""
        lo, hi = asked.agg(F.min(SLICE), F.max(SLICE)).first()
        return rows.filter(F.col(SLICE).between(lo, hi)) if lo is not None else rows.limit(0)

    def _before(self, asked: DataFrame, value) -> DataFrame:
        """Per (key, slice) of the spine the newest row of the slices before, from one row per slice."""
        newest = self.spark.table(self._table("newest"))
        # an append adds a row per (key, slice): the newest of them
        order = self._order(dict(newest.dtypes))
        rest = F.struct(*[F.col(c) for c in order])
        wanted = asked.select(*self.keys, SLICE).distinct().repartition(self.buckets, *self.keys)
        asks = wanted.select(*self.keys, SLICE, F.lit(0).alias("_side"), F.lit(None).cast(value).alias("_v"), F.lit(None).cast(newest.select(rest.alias("o")).schema["o"].dataType).alias("_o"))
        has = newest.select(*self.keys, SLICE, F.lit(1).alias("_side"), F.struct(*self.values).alias("_v"), rest.alias("_o"))
        earlier = Window.partitionBy(*self.keys).orderBy(SLICE, "_side", "_o").rowsBetween(Window.unboundedPreceding, -1)
        return (
            asks.unionByName(has)
            .select(*self.keys, SLICE, "_side", F.last("_v", ignorenulls=True).over(earlier).alias("_before"))
            .filter("_side = 0")
            .drop("_side")
        )

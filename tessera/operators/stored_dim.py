"""Type-2 dimensions as stored tables: bucketed by key, partitioned by validity.

The table's partitions are (is_current, expiration_date): all current versions
are in one, and the versions that one run closed in another. Each partition is
bucketed and sorted by the natural key. A merge therefore

* reads the partition of current versions only, however long the history is;
* joins it to the day's snapshot without moving the dimension: only the
  snapshot is dealt into the dimension's buckets;
* overwrites that partition and adds the partition of the versions closed in
  this run, in one job. Older history is neither read nor written.

A run that is repeated finds nothing changed and leaves the table as it is; a
run that closes more versions on a day that already closed some keeps both.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.rules import OPEN_END
from tessera.operators.scd2 import dim_schema, empty_dim, scd2_merge
from tessera.session import checkpoint_dir, materialize

LAYOUT = ["is_current", "expiration_date"]


class StoredDimension:
    """An external bucketed table. ``buckets`` defaults to the session's
    shuffle partitions, so a snapshot's shuffle meets the buckets one to one."""

    def __init__(self, spark: SparkSession, name: str, snapshot: DataFrame, keys: list[str], tracked: list[str],
                 extra: list[str] | None = None, buckets: int | None = None):
        self.spark, self.keys, self.tracked = spark, keys, tracked
        self.extra = [c for c in extra or [] if c not in tracked]
        self.columns = keys + tracked + self.extra
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.schema = dim_schema(snapshot, self.columns)
        ident = uuid.uuid4().hex[:12]
        self.name, self.path = f"{name}_{ident}", f"{checkpoint_dir(spark).rstrip('/')}/dimensions/{name}-{ident}"
        empty = empty_dim(spark, snapshot, self.columns)
        (empty.select(*self._order()).write.partitionBy(*LAYOUT).bucketBy(self.buckets, *keys).sortBy(*keys)
         .option("path", self.path).format("parquet").saveAsTable(self.name))

    def _order(self) -> list[str]:
        names = [f.name for f in self.schema]
        return [n for n in names if n not in LAYOUT] + LAYOUT

    def read(self) -> DataFrame:
        """All versions, in the usual order of columns."""
        return self.spark.table(self.name).select(*[f.name for f in self.schema])

    def current(self) -> DataFrame:
        """The current versions: one partition of the table."""
        open_end = F.to_date(F.lit(OPEN_END))
        return self.read().where(F.col("is_current") & (F.col("expiration_date") == open_end))

    def plan(self, snapshot: DataFrame, as_of, **rules) -> DataFrame:
        """What a run makes of the current versions: kept, closed and new ones."""
        return scd2_merge(self.current(), snapshot, self.keys, self.tracked, as_of, extra=self.extra, **rules)

    def merge(self, snapshot: DataFrame, as_of, **rules) -> DataFrame:
        """Merge one snapshot (one row per key) as of a business date."""
        merged = self.plan(snapshot, as_of, **rules)
        closed_on = F.date_sub(F.to_date(F.lit(as_of)), 1)
        # Versions that an earlier run of the same day closed stay in their partition.
        earlier = self.read().where(~F.col("is_current") & (F.col("expiration_date") == closed_on))
        staged = materialize(merged.unionByName(earlier), "dimension")
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            staged.select(*self._order()).write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)
        self.spark.catalog.refreshTable(self.name)
        return self.read()

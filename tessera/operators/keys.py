"""Dense surrogate keys without a single-partition window (SNK-07).

Rows are range-partitioned and sorted on the natural key, each partition's
row count is taken (a table of #partitions rows), prefix sums of those
counts give every partition its offset, and ``id = base + offset + position``.
The ranged data is checkpointed first so that both passes see the same
partition boundaries (range bounds come from sampling) and so a lost executor
cannot renumber rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def assign_surrogate(df: DataFrame, order_cols: list[str], id_col: str = "id",
                     base: int = 0, partitions: int | None = None,
                     checkpoint: bool = True) -> DataFrame:
    """Number rows 1.. in ``order_cols`` order (a total order), plus ``base``."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__pos", F.monotonically_increasing_id()
                            - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    if checkpoint:
        # Fix the partition boundaries (sampled) and positions once.
        from tessera.session import materialize
        ranged = materialize(ranged, "surrogate")
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: the window below is over a bounded, tiny table.
    offsets = counts.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"))
    out = ranged.join(F.broadcast(offsets), "__pid")
    return (out.withColumn(id_col, F.lit(base).cast("long") + F.col("__off") + F.col("__pos") + 1)
               .drop("__pid", "__pos", "__off"))


def next_base(existing: DataFrame, id_col: str = "id") -> DataFrame:
    """One-row frame with the current maximum id (0 when empty)."""
    return existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("base"))

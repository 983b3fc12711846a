"""The newest row per key, kept as a stream's state.

Rows may arrive again and out of order. A streaming aggregation holds, per key,
the newest time and the number of arrivals; each ``availableNow`` run takes what
is new in the source folder, writes the keys whose state changed under the batch
id (a replayed batch replaces its own files) and stops. State and progress lie
in the checkpoint folder, so a run after a failure goes on where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def run_latest(spark: SparkSession, source_dir: str, schema: T.StructType, key: str, ts_col: str, root: str) -> DataFrame:
    """Process what is new under ``source_dir``; returns (key, latest,
    arrivals) of every key seen by any run so far."""
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source_dir)
    state = stream.groupBy(F.col(key).alias("key")).agg(F.max(ts_col).alias("latest"), F.count(F.lit(1)).alias("arrivals"))
    out = f"{root.rstrip('/')}/changes"

    def batch(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch_id={epoch}")

    run = (state.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", f"{root.rstrip('/')}/progress")
           .trigger(availableNow=True).start())
    run.awaitTermination()
    changes = spark.read.schema(T.StructType([*state.schema.fields, T.StructField("batch_id", T.LongType())])).parquet(out)
    # A key has one row per batch that changed it: a reduction per key, not a sort.
    newest = changes.groupBy("key").agg(F.max_by(F.struct("latest", "arrivals"), "batch_id").alias("s"))
    return newest.select("key", "s.latest", "s.arrivals")


def latest_watermark(spark: SparkSession, root: str) -> DataFrame:
    """AUD-6: the newest time any run has seen (one row)."""
    return spark.read.parquet(f"{root.rstrip('/')}/changes").agg(F.max("latest").alias("watermark"))

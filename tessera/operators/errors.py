"""Writes that account for their rows: observed counts and an error sink.

``observed_write`` takes the row counts of a step from the write itself
(``Observation``), so no count is another scan. ``split_write`` sends the rows
of one pass to two partitions by outcome; the bad ones are appended to an error
table with run, source table, raw text and reason.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_dir

ERROR_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("run_id", "source_table", "raw_data", "reason")])


def observed_write(df: DataFrame, path: str, counts: dict[str, Column] | None = None, mode: str = "overwrite") -> dict[str, int]:
    """Write ``df`` and return its number of rows and what else is asked for,
    as counted while writing."""
    seen = Observation(f"write-{uuid.uuid4().hex[:12]}")
    exprs = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (counts or {}).items()]]
    df.observe(seen, *exprs).write.mode(mode).parquet(path)
    return {k: int(v or 0) for k, v in seen.get.items()}


def run_steps(spark: SparkSession, run_id: str, steps: list[tuple[str, DataFrame]]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write each (name, frame) to the shared folder in order; returns the
    stored frames and the step log (run_id, step_no, step_name, rows_written).
    A step may read what earlier ones stored: pass a function of the stored
    frames instead of a frame."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/steps/{run_id}-{uuid.uuid4().hex[:12]}"
    stored: dict[str, DataFrame] = {}
    log = []
    for n, (name, step) in enumerate(steps, start=1):
        df = step(stored) if callable(step) else step
        counts = observed_write(df, f"{root}/{name}")
        stored[name] = spark.read.schema(df.schema).parquet(f"{root}/{name}")
        log.append((run_id, n, name, counts["rows"]))
    schema = "run_id string, step_no int, step_name string, rows_written long"
    return stored, spark.createDataFrame(log, schema)


def split_write(rows: DataFrame, json_col: str, schema: T.StructType, source_table: str, run_id: str, root: str,
                required: list[str] | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Decode row JSON in one pass: good rows and bad ones go to two partitions
    of one write, the bad ones then to the error table under ``root``. Returns
    good rows, this run's error rows, and the counts of the write.

    A row is bad if it doesn't decode or lacks a ``required`` field. A run that
    is repeated replaces its own partition of the error table.
    """
    spark = rows.sparkSession
    corrupt = "_corrupt_record"
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed = rows.select(F.col(json_col).alias("raw_data"),
                         F.from_json(json_col, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}).alias("r"))
    undecodable = F.col(json_col if json_col == "raw_data" else "raw_data").isNull() | F.col("r").isNull() | F.col(f"r.{corrupt}").isNotNull()
    reason = F.when(undecodable, "NOT_DECODABLE")
    for field in required or []:
        reason = reason.when(F.col(f"r.{field}").isNull(), f"MISSING_{field.upper()}")
    judged = parsed.select(reason.alias("reason"), "raw_data", *[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])
    staged = f"{root}/staged-{uuid.uuid4().hex[:12]}"
    seen = Observation(f"split-{uuid.uuid4().hex[:12]}")
    (judged.withColumn("outcome", F.when(F.col("reason").isNull(), "good").otherwise("bad"))
     .withColumn("raw_data", F.when(F.col("reason").isNotNull(), F.col("raw_data")))    # good rows need no raw text
     .observe(seen, F.count(F.lit(1)).alias("rows_read"), F.count("reason").alias("rows_failed"))
     .write.partitionBy("outcome").parquet(staged))
    stored = spark.read.schema(T.StructType([T.StructField("reason", T.StringType()), T.StructField("raw_data", T.StringType()), *schema.fields,
                                             T.StructField("outcome", T.StringType())])).parquet(staged)
    errors = f"{root}/error_rows"
    bad = stored.where("outcome = 'bad'").select(F.lit(source_table).alias("source_table"), "raw_data", "reason", F.lit(run_id).alias("run_id"))
    (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(errors))
    mine = read_errors(spark, root).where(F.col("run_id") == run_id)
    return stored.where("outcome = 'good'").select(*[f.name for f in schema.fields]), mine, {k: int(v or 0) for k, v in seen.get.items()}


def read_errors(spark: SparkSession, root: str) -> DataFrame:
    """AUD-5: all runs' rejected rows."""
    return spark.read.schema(ERROR_SCHEMA).parquet(f"{root}/error_rows").select("run_id", "source_table", "raw_data", "reason")

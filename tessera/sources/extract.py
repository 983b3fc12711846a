"""Sources and sinks: table reads, extracts, row JSON, CSV, versioned writes.

Reads are plain ``spark.read``: column projection and filters written after a
read reach the Parquet scan (``ReadSchema`` / ``PushedFilters``).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_dir

TEST_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """SRC-07: one table of a directory of Parquet tables."""
    return spark.read.parquet(os.path.join(base, f"{name}.parquet"))


def tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {t: read_table(spark, base, t) for t in TEST_TABLES}


def extract_projection(df: DataFrame, columns: list[str], where: Column | None = None) -> DataFrame:
    """SRC-01/02: explicit column projection (pruned at the scan)."""
    out = df.select(*columns)
    return out if where is None else out.where(where)


def jdbc_reader(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
                lower: int | None = None, upper: int | None = None, partitions: int = 64,
                fetchsize: int = 100_000, properties: dict | None = None):
    """SRC-01/04: parallel JDBC read; partitions replace a cursor loop.

    Returns the configured reader (call ``.load()``); not exercised offline.
    """
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", str(fetchsize)))
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
              .option("upperBound", str(upper)).option("numPartitions", str(partitions)))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r


def rows_as_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """SRC-03 / JSN-01: each row as one JSON text, NULL fields kept."""
    body = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    cols = [F.col(key)] if key else []
    return df.select(*cols, body.alias("row_json"))


def parse_json_rows(df: DataFrame, json_col: str, schema: T.StructType,
                    corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Decode row JSON; undecodable rows go to a separate error frame.

    PERMISSIVE parsing keeps the raw text of a bad row in ``corrupt_col``;
    returns (good rows, bad rows holding only the raw text).
    """
    full = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
    parsed = df.select("*", F.from_json(F.col(json_col), full,
                                        {"mode": "PERMISSIVE",
                                         "columnNameOfCorruptRecord": corrupt_col}).alias("__r"))
    bad_cond = F.col(f"__r.{corrupt_col}").isNotNull() | F.col("__r").isNull()
    good = parsed.where(~bad_cond).select(*[F.col(f"__r.{f.name}").alias(f.name) for f in schema.fields])
    bad = parsed.where(bad_cond).select(F.col(json_col).alias(corrupt_col))
    return good, bad


def incremental_extract(df: DataFrame, ts_col: str, last_ts) -> tuple[DataFrame, DataFrame]:
    """SRC-11: rows updated at/after the watermark, and the next watermark.

    The next watermark is ``max(ts)`` of the extracted rows, or the old value
    when nothing is new.
    """
    lit_ts = F.lit(last_ts).cast(df.schema[ts_col].dataType)
    rows = df.where(F.col(ts_col) >= lit_ts)
    nxt = rows.agg(F.coalesce(F.max(ts_col), lit_ts).alias("next_watermark"),
                   F.count(F.lit(1)).alias("rows_extracted"))
    return rows, nxt


def write_csv(df: DataFrame, path: str) -> None:
    """SRC-10: headerless CSV, empty field = NULL."""
    df.write.mode("overwrite").option("header", "false").option("nullValue", "") \
      .option("emptyValue", "\"\"").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", "false").option("nullValue", "").csv(path)


def new_version_path(root: str, table: str) -> str:
    """SNK-01: each overwrite goes to a fresh version folder, so a step may
    read the previous version of the same table while writing the next."""
    return os.path.join(root, table, f"v-{uuid.uuid4().hex[:12]}")


def write_version(df: DataFrame, root: str, table: str, partition_by: list[str] | None = None) -> str:
    path = new_version_path(root, table)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append_rows(spark: SparkSession, name: str, batches: list[DataFrame]) -> DataFrame:
    """SNK-02: append each batch to one log table in the shared folder and
    read the whole log back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/logs/{name}-{uuid.uuid4().hex[:12]}"
    for batch in batches:
        batch.write.mode("append").parquet(path)
    return spark.read.parquet(path)

"""Helpers of the operators: tables in the shared folder, checked broadcasts,
words as a column expression."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

# What separates words: space, tab, line feed, vertical tab, form feed, return.
SPACE_CLASS = r"\x20\x09-\x0D"

# Broadcasts take tables of fixed-width rows (a few longs) up to this many
# rows: under 64 MB as a hash table. Larger ones are joined by shuffling.
BROADCAST_ROWS = 1_000_000


class Scratch:
    """Intermediate tables of one run, as Parquet in the shared folder that the
    session's ``spark.checkpoint.dir`` names; an executor's loss loses none."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, step: str) -> str:
        return f"{self.root}/{step}"

    def save(self, df: DataFrame, step: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(step))
        return self.spark.read.schema(df.schema).parquet(self.path(step))

    def drop(self, *steps: str) -> None:
        """Remove tables that no later step reads."""
        jvm = self.spark._jvm
        for step in steps:
            path = jvm.org.apache.hadoop.fs.Path(self.path(step))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def maybe_broadcast(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has ``limit`` rows at most. Meant for
    stored tables of fixed-width rows, whose count comes from file footers;
    beyond the limit the join shuffles and gives the same rows."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= limit else df


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def split_words(text: Column) -> Column:
    """Array of the words of a text (``[^\\x20\\x09-\\x0D]+``)."""
    return F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, in one expression that no
    projection or filter rewrite can take apart and compute again."""
    return F.transform(F.array(value), body)[0]

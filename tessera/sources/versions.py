"""Versioned tables and changing schemas (SNK-01, SRC-05).

A reload writes a whole new version beside the one that is read; readers take
the newest complete version (its success marker is there) and never see one that
is still being written. ``prune`` removes old versions and those a failed write
left behind.

``schema_changes`` compares the columns of two versions; ``aligned`` reads a
frame as a wanted schema: missing columns are null, types that only became wider
are cast, others are refused.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHANGES = "column_name string, change string, old_type string, new_type string"
# Types that hold all values of the ones before them in the same line.
WIDER = [["tinyint", "smallint", "int", "bigint"], ["float", "double"], ["date", "timestamp_ntz"]]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, root: str, table: str) -> list[tuple[str, bool]]:
    """(folder, complete) of a table's versions, oldest first."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/{table}")
    if not fs.exists(p):
        return []
    found = sorted(f.getPath().getName() for f in fs.listStatus(p) if f.getPath().getName().startswith("v-"))
    return [(f"{root.rstrip('/')}/{table}/{n}", fs.exists(_fs(spark, f"{root.rstrip('/')}/{table}/{n}/_SUCCESS")[1])) for n in found]


def reload(df: DataFrame, root: str, table: str, partition_by: list[str] | None = None) -> str:
    """SNK-01: write ``df`` as the table's next version and return its folder.
    ``df`` may read the version before."""
    path = f"{root.rstrip('/')}/{table}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return path


def newest(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The newest complete version."""
    done = [path for path, complete in versions(spark, root, table) if complete]
    if not done:
        raise FileNotFoundError(f"{table} has no complete version under {root}")
    return spark.read.parquet(done[-1])


def prune(spark: SparkSession, root: str, table: str, keep: int = 2) -> list[str]:
    """Remove all but the newest ``keep`` complete versions, and incomplete ones
    older than the newest complete one (a younger one may still be written)."""
    found = versions(spark, root, table)
    done = [path for path, complete in found if complete]
    kept = set(done[-keep:])
    old = [path for path, complete in found if path not in kept and (complete or done and path < done[-1])]
    for path in old:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    return old


def _widens(old: str, new: str) -> bool:
    return any(old in line and new in line and line.index(old) < line.index(new) for line in WIDER)


def schema_changes(old: T.StructType, new: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, change, old type, new type): ADDED, REMOVED, WIDENED or CHANGED;
    equal columns are left out."""
    before, after = ({f.name: f.dataType.simpleString() for f in s} for s in (old, new))
    out: list[tuple[str, str, str | None, str | None]] = [(n, "ADDED", None, t) for n, t in after.items() if n not in before]
    out += [(n, "REMOVED", t, None) for n, t in before.items() if n not in after]
    out += [(n, "WIDENED" if _widens(t, after[n]) else "CHANGED", t, after[n]) for n, t in before.items() if n in after and after[n] != t]
    return sorted(out)


def discovered(spark: SparkSession, old: T.StructType, new: T.StructType) -> DataFrame:
    """SRC-05: the changes as a table."""
    return spark.createDataFrame(schema_changes(old, new), CHANGES)


def aligned(df: DataFrame, wanted: T.StructType) -> DataFrame:
    """``df`` with the columns of ``wanted``, in order."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    bad = [f.name for f in wanted if f.name in have and have[f.name] != f.dataType.simpleString() and not _widens(have[f.name], f.dataType.simpleString())]
    if bad:
        raise ValueError(f"columns {bad} changed their type in a way that loses values")
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted])


def all_versions(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of all complete versions as the newest one's schema."""
    wanted = newest(spark, root, table).schema
    out = None
    for path, complete in versions(spark, root, table):
        if complete:
            rows = aligned(spark.read.parquet(path), wanted).withColumn("version", F.lit(path.rpartition("/")[2]))
            out = rows if out is None else out.unionByName(rows)
    return out

"""A copy in chunks that can be stopped and resumed (SRC-04).

The key range is cut into chunks at quantiles, so chunks hold about equally many
rows however the keys lie. Each chunk is one write into a folder of its own and
is entered in a ledger when it is complete; a copy that is started again does
the chunks that the ledger lacks. The plan of chunks is stored with the copy, so
a resumed copy cuts where the first one did. Rows with a null key are a chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.errors import observed_write

CHUNKS = "chunk int, low long, high long"
LEDGER = "chunk int, rows long"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def chunk_plan(source: DataFrame, key: str, chunks: int) -> list[tuple[int, int | None, int | None]]:
    """(chunk, low, high): keys from ``low`` on and below ``high``; null bounds
    are open, and chunk 0 holds the rows without a key. A key so frequent that
    several quantiles fall on it makes one chunk."""
    cuts = source.select(F.percentile_approx(F.col(key).cast("long"), [i / chunks for i in range(1, chunks)], 10_000).alias("q")).first()["q"] if chunks > 1 else None
    bounds = [None, *sorted(set(cuts or [])), None]
    return [(0, None, None), *[(n + 1, low, high) for n, (low, high) in enumerate(zip(bounds, bounds[1:]))]]


def _rows(source: DataFrame, key: str, chunk: int, low: int | None, high: int | None) -> DataFrame:
    k = F.col(key)
    if chunk == 0:
        return source.where(k.isNull())
    rows = source.where(k.isNotNull())
    rows = rows if low is None else rows.where(k >= low)
    return rows if high is None else rows.where(k < high)


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """(chunk, rows) of the chunks that are complete."""
    path = f"{target.rstrip('/')}/ledger"
    return spark.read.schema(LEDGER).parquet(path) if _exists(spark, path) else spark.createDataFrame([], LEDGER)


def copy_in_chunks(source: DataFrame, key: str, target: str, chunks: int = 16, at_most: int | None = None) -> int:
    """Copy ``source`` to ``target``; returns how many chunks are left.
    ``at_most`` stops after so many chunks, as a time limit would. A filter on
    the key range reaches the source's scan, so chunks outside are not read."""
    spark, root = source.sparkSession, target.rstrip("/")
    if not _exists(spark, f"{root}/plan"):
        spark.createDataFrame(chunk_plan(source, key, chunks), CHUNKS).coalesce(1).write.parquet(f"{root}/plan")
    plan = [tuple(r) for r in spark.read.schema(CHUNKS).parquet(f"{root}/plan").orderBy("chunk").collect()]
    done = {r["chunk"] for r in ledger(spark, root).collect()}
    todo = [c for c in plan if c[0] not in done]
    for chunk, low, high in todo[:at_most]:
        counts = observed_write(_rows(source, key, chunk, low, high), f"{root}/rows/chunk={chunk}")
        spark.createDataFrame([(chunk, counts["rows"])], LEDGER).coalesce(1).write.mode("append").parquet(f"{root}/ledger")
    return len(todo) - len(todo[:at_most])


def copied(spark: SparkSession, source: DataFrame, target: str) -> DataFrame:
    """The rows of all complete chunks. A chunk whose write was cut off is not
    in the ledger and not read; the resumed copy writes it again."""
    root = target.rstrip("/")
    done = [r["chunk"] for r in ledger(spark, root).collect()]
    if not done:
        return spark.createDataFrame([], source.schema)
    return spark.read.schema(source.schema).parquet(*[f"{root}/rows/chunk={c}" for c in sorted(done)])

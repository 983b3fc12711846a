"""Exact distinct counts that roll up: bitmaps per group, merged level by level.

``bitmaps`` reads the rows once and keeps, per finest group and block of 64 ids,
a bitmap of the ids seen, as one long. Any coarser level merges those bitmaps by
``or``; the rows are not read again and a member that several groups share is
counted once. A group of few members spread over many ids costs 8 bytes a block,
and longs are merged by hash aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 6      # 64 ids: what a long holds


def bitmaps(rows: DataFrame, groups: list[str], member: str) -> DataFrame:
    """(groups..., bucket, seen): ``member`` must be an integer; rows without
    one are left out."""
    ids = rows.where(F.col(member).isNotNull())
    m = F.col(member).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), m.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    return (ids.select(*groups, F.shiftright(m, BLOCK_BITS).alias("bucket"), bit.alias("bit"))
            .groupBy(*groups, "bucket").agg(F.bit_or("bit").alias("seen")))


def merged(bits: DataFrame, groups: list[str]) -> DataFrame:
    """Bitmaps of a coarser level."""
    return bits.groupBy(*groups, "bucket").agg(F.bit_or("seen").alias("seen"))


def distinct_counts(bits: DataFrame, groups: list[str], counts: dict[str, Column | None]) -> DataFrame:
    """Distinct members by group: one column per entry of ``counts``, over the
    bitmaps that its condition (on the finer group's columns) selects."""
    if not counts:
        raise ValueError("no count asked for")
    # Members of several finer groups are merged before they are counted.
    flags = {n: (F.lit(True) if c is None else F.coalesce(c, F.lit(False))) for n, c in counts.items()}
    per_bucket = bits.groupBy(*groups, "bucket").agg(
        *[F.bit_or(F.when(c, F.col("seen"))).alias(n) for n, c in flags.items()])
    return per_bucket.groupBy(*groups).agg(*[F.coalesce(F.sum(F.bit_count(n)), F.lit(0)).alias(n) for n in counts])

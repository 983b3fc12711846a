"""Fact loaders built from as-of lookups and keyed inserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.asof import asof_version, current_version, earliest_version
from tessera.operators.joins import sized


def snapshot_fact(dim: DataFrame, key: str, as_of, current_col: str = "is_current") -> DataFrame:
    """FCT-01: one row per current dim row for the business date.

    The business date is the partition value of the snapshot fact (write with
    ``partitionBy("snapshot_date")``); whether the date dimension covers it is
    a data-quality check (``date_dim_covers``), not a join on a constant.
    """
    day = F.to_date(F.lit(as_of))
    return dim.where(F.col(current_col)).select(F.col(key), day.alias("snapshot_date"))


def date_dim_covers(date_dim: DataFrame, as_of) -> DataFrame:
    """One-row count of date_dim rows on the business date (0 = not covered)."""
    return date_dim.where(F.col("system_date") == F.to_date(F.lit(as_of))) \
                   .agg(F.count(F.lit(1)).alias("n"))


def load_fact_fallback(flat: DataFrame, dims: list[dict], date_col: str,
                       closed: bool = True) -> DataFrame:
    """FCT-02: resolve every dim as of ``date_col``; all-or-nothing fallback.

    ``dims``: dicts with ``dim`` (SCD2 frame), ``fact_key``, ``dim_key``,
    ``take`` (columns to attach) and ``prefix``. When every dim resolves as of
    the date, those versions are used; otherwise every dim takes its earliest
    version. Rows that resolve neither way are dropped here and reported by
    ``unresolved``. Adds ``resolution`` = 'ASOF' | 'EARLIEST'.
    """
    out, ok, known = flat, F.lit(True), F.lit(True)
    for d in dims:
        dim = sized(d["dim"])
        first = earliest_version(dim, d["dim_key"], d["take"])
        first = first.select(F.col(d["dim_key"]).alias(f"{d['prefix']}__first_key"),
                             *[F.col(c).alias(f"{d['prefix']}__first_{c}") for c in d["take"]])
        # Both joins are on the fact key: the fact is shuffled once per dim.
        out = asof_version(out, dim, d["fact_key"], d["dim_key"], date_col, d["take"], d["prefix"], closed=closed)
        out = out.join(first, F.col(d["fact_key"]) == F.col(f"{d['prefix']}__first_key"), "left")
        ok = ok & F.col(f"{d['prefix']}_{d['take'][0]}").isNotNull()
        known = known & F.col(f"{d['prefix']}__first_key").isNotNull()
    taken = [F.when(ok, F.col(f"{d['prefix']}_{c}")).otherwise(F.col(f"{d['prefix']}__first_{c}")).alias(f"{d['prefix']}_{c}")
             for d in dims for c in d["take"]]
    return out.where(ok | known).select(*flat.columns, *taken, F.when(ok, "ASOF").otherwise("EARLIEST").alias("resolution"))


def load_fact_earliest(flat: DataFrame, dims: list[dict]) -> DataFrame:
    """FCT-03: every dim takes its earliest version (inner joins)."""
    out = flat
    for d in dims:
        first = earliest_version(sized(d["dim"]), d["dim_key"], d["take"])
        first = first.select(F.col(d["dim_key"]).alias(f"{d['prefix']}__key"),
                             *[F.col(c).alias(f"{d['prefix']}_{c}") for c in d["take"]])
        out = out.join(first, F.col(d["fact_key"]) == F.col(f"{d['prefix']}__key")) \
                 .drop(f"{d['prefix']}__key")
    return out


def load_fact_current(flat: DataFrame, dims: list[dict]) -> DataFrame:
    """FCT-04: every dim takes its current version (inner joins)."""
    out = flat
    for d in dims:
        cur = current_version(sized(d["dim"]), d["dim_key"], d["take"] + [d["dim_key"]])
        cur = cur.select(F.col(d["dim_key"]).alias(f"{d['prefix']}__key"),
                         *[F.col(c).alias(f"{d['prefix']}_{c}") for c in d["take"]])
        out = out.join(cur, F.col(d["fact_key"]) == F.col(f"{d['prefix']}__key")) \
                 .drop(f"{d['prefix']}__key")
    return out


def unresolved(flat: DataFrame, fact: DataFrame, keys: list[str]) -> DataFrame:
    """FCT-05: staged rows whose conflict key did not reach the fact."""
    return flat.join(fact.select(*keys), keys, "left_anti")

"""Catalogue of registered queries: a Spark builder plus its oracle SQL.

Every builder takes ``(spark, base_dir)`` and reads whole tables from
``base_dir``; the SQL runs on DuckDB over the same tables (views named like
the Parquet files). Columns carry the same names and types on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.extract import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


class Tables:
    """Lazy accessor: ``t.orders`` reads ``<base>/orders.parquet``."""

    def __init__(self, spark: SparkSession, base: str):
        self._spark, self._base = spark, base
        self._memo: dict = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self._spark, self._base, name)

    def step(self, key, build):
        """Build a pipeline step once per query build (one nightly run's
        dimension or staging table is produced once and read by every later
        step of the same query; nothing is shared between queries)."""
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]


def load_all():
    """Import every catalogue module so its queries register."""
    from tessera.plans import (q_warehouse, q_relational, q_scalar, q_quality,  # noqa: F401
                               q_marts, q_reports, q_edu, q_runs, q_stored, q_staff, q_transfers, q_ids)
    return QUERIES, ORACLE

"""Surrogate ids of dimension versions, and facts that carry them.

The ids of a dimension live in a narrow table (key, effective date, id) beside
it: a run numbers only the versions that it opened and leaves the others' ids
as they are, so a fact loaded earlier stays right. Expiring or re-reading a
version doesn't touch its id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.scd2 import assign_new_ids

VERSION = "effective_date"


def number_versions(dim: DataFrame, keys: list[str], ids: DataFrame | None = None) -> DataFrame:
    """(keys, effective_date, id) of every version of ``dim``. Versions that
    ``ids`` holds keep theirs; new ones are numbered after the largest, by date
    and key. Ids of versions that ``dim`` no longer has are not given again
    while ``ids`` is passed on."""
    have = dim.select(*keys, VERSION)
    if ids is None:
        return assign_new_ids(have.withColumn("id", F.lit(None).cast("long")), "id", [VERSION, *keys])
    known = ids.select(*keys, VERSION, "id")
    # the full join keeps retired versions, so that the largest id is never reused
    return assign_new_ids(known.join(have, [*keys, VERSION], "full_outer"), "id", [VERSION, *keys])


def with_version_id(rows: DataFrame, ids: DataFrame, on: dict[str, str], version: str, out: str) -> DataFrame:
    """``rows`` with the id of the version they name: ``on`` maps key columns of
    ``ids`` to those of ``rows``. Rows whose version is unknown or null get a
    null id; none is lost."""
    named = ids.select(*[F.col(k).alias(f"__id_{k}") for k in on], F.col(VERSION).alias("__id_version"), F.col("id").alias(out))
    cond = rows[version] == named["__id_version"]
    for k, c in on.items():
        cond = cond & (rows[c] == named[f"__id_{k}"])
    return rows.join(named, cond, "left").drop("__id_version", *[f"__id_{k}" for k in on])

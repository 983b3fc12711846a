"""Type-2 slowly changing dimensions, rebuilt instead of updated.

``scd2_merge`` joins today's snapshot to the *current* versions only (one
full outer join on the natural key), and every joined row emits one or two
output rows through a single ``explode``: the kept/expired old version and
the new version. Historical versions are carried through untouched, so on a
dimension stored partitioned by ``is_current`` only the current partition is
read for the join; the history partition is copied without a shuffle.

Decisions (documented, not configurable unless stated):
* keys absent from the snapshot stay current (no delete detection);
* a change on the day the current version started replaces that version in
  place instead of producing ``expiration_date < effective_date``;
* change lists compare null-safely, so NULL <-> value changes are named;
* every tracked column can appear in ``changed_fields``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.rules import (ATTRIBUTE_CHANGE, ATTRIBUTE_UPDATE, INITIAL_LOAD,
                                     OPEN_END, change_hash)

CONTROL = ["effective_date", "expiration_date", "is_current",
           "change_hash", "change_reason", "changed_fields"]


def dim_schema(snapshot: DataFrame, columns: list[str]) -> T.StructType:
    fields = [snapshot.schema[c] for c in columns]
    fields += [T.StructField("effective_date", T.DateType()),
               T.StructField("expiration_date", T.DateType()),
               T.StructField("is_current", T.BooleanType()),
               T.StructField("change_hash", T.StringType()),
               T.StructField("change_reason", T.StringType()),
               T.StructField("changed_fields", T.StringType())]
    return T.StructType(fields)


def empty_dim(spark: SparkSession, snapshot: DataFrame, columns: list[str]) -> DataFrame:
    return spark.createDataFrame([], dim_schema(snapshot, columns))


def _differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def scd2_merge(dim: DataFrame, snapshot: DataFrame, keys: list[str], tracked: list[str],
               as_of, *, extra: list[str] | None = None, hash_defaults: dict | None = None,
               reason_rules: list[tuple[str, str]] | None = None,
               initial_fields: str = INITIAL_LOAD,
               current_col: str = "is_current") -> DataFrame:
    """Merge one snapshot (one row per key) into an SCD2 dimension.

    ``reason_rules``: ordered (column, text) pairs; the first differing column
    names the change (else ``'Attribute update'``). Without rules every change
    is ``'ATTRIBUTE_CHANGE'``. ``initial_fields`` is the ``changed_fields``
    text of a first version (``'ALL'`` for schools, ``'INITIAL_LOAD'``
    elsewhere).
    """
    extra = extra or []
    attrs = tracked + [c for c in extra if c not in tracked]
    cols = keys + attrs
    as_of = F.to_date(F.lit(as_of)) if not isinstance(as_of, Column) else as_of
    open_end = F.to_date(F.lit(OPEN_END))

    dim = dim.withColumnRenamed(current_col, "is_current") if current_col != "is_current" else dim
    current = dim.where(F.col("is_current"))
    history = dim.where(~F.col("is_current"))

    key_ok = None
    for k in keys:
        key_ok = F.col(k).isNotNull() if key_ok is None else key_ok & F.col(k).isNotNull()
    snap = (snapshot.where(key_ok)
                    .select(*cols, change_hash(tracked, hash_defaults).alias("change_hash")))

    s = snap.select(*[F.col(c).alias(f"s__{c}") for c in snap.columns])
    c = current.select(*[F.col(x).alias(f"c__{x}") for x in cols + CONTROL])
    on = None
    for k in keys:
        e = F.col(f"s__{k}") == F.col(f"c__{k}")
        on = e if on is None else on & e
    j = s.join(c, on, "full_outer")

    has_s = F.col(f"s__{keys[0]}").isNotNull()
    has_c = F.col(f"c__{keys[0]}").isNotNull()
    changed = has_s & has_c & (F.col("s__change_hash") != F.col("c__change_hash"))
    same_day = F.col("c__effective_date") == as_of

    if reason_rules:
        reason = None
        for col_name, text in reason_rules:
            d = _differs(F.col(f"c__{col_name}"), F.col(f"s__{col_name}"))
            reason = F.when(d, F.lit(text)) if reason is None else reason.when(d, F.lit(text))
        reason = reason.otherwise(F.lit(ATTRIBUTE_UPDATE))
    else:
        reason = F.lit(ATTRIBUTE_CHANGE)
    fields = F.concat_ws(",", *[F.when(_differs(F.col(f"c__{x}"), F.col(f"s__{x}")), F.lit(x))
                                for x in tracked])

    def version(prefix: str, eff, exp, cur, hash_, why, what) -> Column:
        parts = [F.col(f"{prefix}{x}").alias(x) for x in cols]
        parts += [eff.alias("effective_date"), exp.alias("expiration_date"),
                  cur.alias("is_current"), hash_.alias("change_hash"),
                  why.alias("change_reason"), what.alias("changed_fields")]
        return F.struct(*parts)

    kept_old = version("c__", F.col("c__effective_date"), F.col("c__expiration_date"),
                       F.col("c__is_current"), F.col("c__change_hash"),
                       F.col("c__change_reason"), F.col("c__changed_fields"))
    expired_old = version("c__", F.col("c__effective_date"), F.date_sub(as_of, 1),
                          F.lit(False), F.col("c__change_hash"),
                          F.col("c__change_reason"), F.col("c__changed_fields"))
    new_first = version("s__", as_of, open_end, F.lit(True), F.col("s__change_hash"),
                        F.lit(INITIAL_LOAD), F.lit(initial_fields))
    new_change = version("s__", as_of, open_end, F.lit(True), F.col("s__change_hash"),
                         F.when(same_day, F.col("c__change_reason")).otherwise(reason),
                         F.when(same_day, F.col("c__changed_fields")).otherwise(fields))

    old_out = (F.when(has_c & ~changed, kept_old)
                .when(changed & ~same_day, expired_old))
    new_out = (F.when(has_s & ~has_c, new_first)
                .when(changed, new_change))
    emitted = (j.select(F.explode(F.filter(F.array(old_out, new_out), lambda v: v.isNotNull()))
                        .alias("v"))
                .select("v.*"))
    out = history.select(*cols, *CONTROL).unionByName(emitted)
    if current_col != "is_current":
        out = out.withColumnRenamed("is_current", current_col)
    return out


def scd2_stats(dim: DataFrame, current_col: str = "is_current") -> DataFrame:
    """SCD-03: total / current / historical version counts in one pass."""
    return dim.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_if(F.col(current_col)).alias("current_rows"),
                   F.count_if(~F.col(current_col)).alias("historical_rows"))


def scd2_gaps(dim: DataFrame, keys: list[str]) -> DataFrame:
    """SCD-04: consecutive versions that do not tile (exp + 1 <> next eff).

    The next version is found with ``lead`` over the key's versions; a key's
    version count is bounded by the number of loads, not by data volume.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy("effective_date", "expiration_date")
    nxt = dim.withColumn("next_effective_date", F.lead("effective_date").over(w))
    return (nxt.where(F.col("next_effective_date").isNotNull() &
                      (F.date_add("expiration_date", 1) != F.col("next_effective_date")))
               .select(*keys, "effective_date", "expiration_date", "next_effective_date"))


def scd2_history(dim: DataFrame, key_filter: Column | None = None,
                 changed_field: str | None = None) -> DataFrame:
    """SCD-05: versions of some keys, or versions where a field changed."""
    out = dim
    if key_filter is not None:
        out = out.where(key_filter)
    if changed_field is not None:
        out = out.where(F.col("changed_fields").like(f"%{changed_field}%"))
    return out


def assign_new_ids(dim: DataFrame, id_col: str, order_cols: list[str]) -> DataFrame:
    """SNK-07 for SCD2 versions: keep existing ids, number the new versions
    (NULL id) after the current maximum in natural-key order."""
    from tessera.operators.keys import assign_surrogate
    from tessera.session import materialize
    dim = materialize(dim)
    have = dim.where(F.col(id_col).isNotNull())
    fresh = dim.where(F.col(id_col).isNull()).drop(id_col)
    base = have.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"]
    numbered = assign_surrogate(fresh, order_cols, id_col=id_col, base=int(base))
    return materialize(have.unionByName(numbered.select(*dim.columns)))

"""Data-quality checks: each is a count plus a threshold rule -> one log row.

Checks over the same table are computed in one aggregate (``count_checks``)
and turned into rows with ``stack``; rows without a partner (orphans, missing
in fact) are counted key by key over both tables (``unmatched``). All results share ``RESULT_COLS``
so a suite is a ``unionByName`` of one-row frames, written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLS = ["mart", "check_name", "row_count", "status", "severity"]

# A rule is (comparison, threshold, status); the first rule that holds wins,
# otherwise the check passes.
FAIL_IF_ANY = [("gt", 0, "FAIL")]
WARN_IF_ANY = [("gt", 0, "WARN")]
WARNING_IF_ANY = [("gt", 0, "WARNING")]
FAIL_IF_EMPTY = [("eq", 0, "FAIL")]
INFO = [("ge", 0, "INFO")]
ALWAYS_PASS: list = []

_OPS = {"gt": lambda c, t: c > t, "ge": lambda c, t: c >= t, "eq": lambda c, t: c == t,
        "lt": lambda c, t: c < t, "le": lambda c, t: c <= t}


def status_of(count: Column, rules: list) -> Column:
    out = None
    for op, thr, status in rules:
        cond = _OPS[op](count, F.lit(thr))
        out = F.when(cond, F.lit(status)) if out is None else out.when(cond, F.lit(status))
    return F.lit("PASS") if out is None else out.otherwise(F.lit("PASS"))


def severity_of(status: Column) -> Column:
    return (F.when(status == "FAIL", F.lit("CRITICAL"))
             .when(status.isin("WARN", "WARNING"), F.lit("WARNING"))
             .otherwise(F.lit("INFO")))


def _finish(df: DataFrame, mart: str, name_col: Column, count_col: Column, rules_by_name: dict) -> DataFrame:
    status = None
    for name, rules in rules_by_name.items():
        st = status_of(count_col, rules)
        status = F.when(name_col == name, st) if status is None else status.when(name_col == name, st)
    return df.select(F.lit(mart).alias("mart"), name_col.alias("check_name"),
                     count_col.cast("long").alias("row_count"),
                     status.alias("status")).withColumn("severity", severity_of(F.col("status")))


def count_checks(df: DataFrame, mart: str, checks: dict[str, tuple[Column, list]]) -> DataFrame:
    """Many conditional counts over one table in a single scan.

    ``checks``: name -> (condition, rules). ``F.lit(True)`` counts all rows.
    """
    names = list(checks)
    agg = df.agg(*[F.count_if(checks[n][0]).alias(f"c{i}") for i, n in enumerate(names)])
    pairs = ", ".join(f"'{n}', c{i}" for i, n in enumerate(names))
    rows = agg.selectExpr(f"stack({len(names)}, {pairs}) as (check_name, row_count)")
    return _finish(rows, mart, F.col("check_name"), F.col("row_count"),
                   {n: checks[n][1] for n in names})


def single(count_df: DataFrame, mart: str, name: str, rules: list, col: str = "n") -> DataFrame:
    """Wrap a one-row frame holding a count column ``col``."""
    return _finish(count_df, mart, F.lit(name), F.col(col), {name: rules})


def not_empty(df: DataFrame, mart: str, name: str, warn_below: int | None = None) -> DataFrame:
    rules = FAIL_IF_EMPTY + ([("lt", warn_below, "WARN")] if warn_below else [])
    return single(df.agg(F.count(F.lit(1)).alias("n")), mart, name, rules)


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One-row count ``n`` of the rows of ``left`` whose ``keys`` no row of
    ``right`` has (NULL keys count): an anti join and its count as one aggregate.

    Both tables are reduced per key before they are shuffled, and neither is
    ever broadcast: file sizes say too little of a stored fact's rows for that.
    """
    rows = (left.select(*keys, F.lit(1).alias("__l"), F.lit(0).alias("__r"))
                .unionByName(right.select(*keys, F.lit(0).alias("__l"), F.lit(1).alias("__r")).dropna(subset=keys)))
    lonely = rows.groupBy(*keys).agg(F.sum("__l").alias("__n"), F.max("__r").alias("__r")).where("__r = 0")
    return lonely.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"))


def orphan_count(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
                 mart: str, name: str, rules=FAIL_IF_ANY, parent_filter: Column | None = None) -> DataFrame:
    """Child rows whose key has no parent row (NULL keys count as orphans)."""
    p = parent if parent_filter is None else parent.where(parent_filter)
    n = unmatched(child.select(F.col(child_key).alias("__pk")), p.select(F.col(parent_key).alias("__pk")), ["__pk"])
    return single(n, mart, name, rules)


def duplicate_count(df: DataFrame, keys: list[str], mart: str, name: str,
                    rules=FAIL_IF_ANY) -> DataFrame:
    """Number of key values occurring more than once (NULL forms a group)."""
    n = (df.groupBy(*keys).count().where("count > 1")
           .agg(F.count(F.lit(1)).alias("n")))
    return single(n, mart, name, rules)


def missing_in_fact(dim: DataFrame, dim_key: str, fact: DataFrame, fact_key: str,
                    mart: str, name: str, rules=WARN_IF_ANY) -> DataFrame:
    n = unmatched(dim.select(F.col(dim_key).alias("__fk")), fact.select(F.col(fact_key).alias("__fk")), ["__fk"])
    return single(n, mart, name, rules)


def distinct_at_least(df: DataFrame, col: str, minimum: int, mart: str, name: str,
                      status: str = "WARN") -> DataFrame:
    n = df.agg(F.count_distinct(col).alias("n"))
    return single(n, mart, name, [("lt", minimum, status)])


def variance(fact_count: DataFrame, stage_count: DataFrame, mart: str, name: str,
             tolerance: float = 0.01) -> DataFrame:
    """|fact - stage| / stage < tolerance passes; anything else (incl. stage 0) warns.

    Inputs are one-row frames with column ``n``; the result's ``row_count`` is
    the fact count.
    """
    none = F.lit(None).cast("long")
    j = (fact_count.select(F.col("n").cast("long").alias("f"), none.alias("s"))
         .unionByName(stage_count.select(none.alias("f"), F.col("n").cast("long").alias("s")))
         .agg(F.max("f").alias("f"), F.max("s").alias("s")))
    ratio = F.abs(F.col("f") - F.col("s")).cast("double") / F.nullif(F.col("s"), F.lit(0)).cast("double")
    return (j.select(F.lit(mart).alias("mart"), F.lit(name).alias("check_name"),
                     F.col("f").cast("long").alias("row_count"),
                     F.when(ratio < tolerance, F.lit("PASS")).otherwise(F.lit("WARNING")).alias("status"))
             .withColumn("severity", severity_of(F.col("status"))))


def suite(*checks: DataFrame) -> DataFrame:
    out = checks[0].select(*RESULT_COLS)
    for c in checks[1:]:
        out = out.unionByName(c.select(*RESULT_COLS))
    return out


def summary(results: DataFrame) -> DataFrame:
    """E-S/T-S/N-S: per-mart tallies of the statuses."""
    st = F.col("status")
    return results.groupBy("mart").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(st == "PASS").alias("passed"),
        F.count_if(st.isin("WARN", "WARNING")).alias("warnings"),
        F.count_if(st == "FAIL").alias("failed"),
        F.count_if(st == "INFO").alias("info"))


def raise_on_fail(summary_df: DataFrame) -> None:
    """Raise after the results were persisted (a FAIL never rolls back the log)."""
    failed = summary_df.agg(F.coalesce(F.sum("failed"), F.lit(0)).alias("f")).first()["f"]
    if failed:
        raise RuntimeError(f"{failed} data-quality check(s) failed")

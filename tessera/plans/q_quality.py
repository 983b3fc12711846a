"""Data-quality checks over the warehouse outputs built from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.plans import views as V
from tessera.plans.q_marts import enrolment_indicators, school_indicators, ENROLMENT_SQL
from tessera.plans.q_warehouse import customer_dim
from tessera.session import materialize
from tessera.plans.registry import Tables, query

_OPS = {"gt": ">", "ge": ">=", "eq": "=", "lt": "<", "le": "<="}


def _status_sql(rules, n="n"):
    if not rules:
        return "'PASS'"
    return "CASE " + " ".join(f"WHEN {n} {_OPS[op]} {thr} THEN '{st}'" for op, thr, st in rules) + " ELSE 'PASS' END"


def check_sql(mart: str, name: str, count_sql: str, rules) -> str:
    st = _status_sql(rules)
    return (f"SELECT '{mart}' AS mart, '{name}' AS check_name, CAST(n AS BIGINT) AS row_count, {st} AS status, "
            f"CASE {st} WHEN 'FAIL' THEN 'CRITICAL' WHEN 'WARN' THEN 'WARNING' WHEN 'WARNING' THEN 'WARNING' "
            f"ELSE 'INFO' END AS severity FROM ({count_sql}) AS x(n)")



def _dim(spark, t):
    """The customer dimension, stored once per query build for all checks."""
    return t.step("customer_dim", lambda: materialize(customer_dim(spark, t._base, 3), "customer_dim"))


DIM_ROWS_RULES = Q.FAIL_IF_EMPTY + [("lt", 80000, "WARN")]

# Spark check builders and their SQL, keyed by the catalogue entry.


def not_empty_checks(spark, t):
    dim = _dim(spark, t)
    return Q.suite(Q.not_empty(dim.where("is_current"), "customer", "customer_dim_row_count", warn_below=80000),
                   Q.not_empty(t.lineitem, "lineitem", "lineitem_staged_rows"))


NOT_EMPTY_SQL = " UNION ALL ".join([
    check_sql("customer", "customer_dim_row_count", "SELECT count(*) FROM dim3 WHERE is_current", DIM_ROWS_RULES),
    check_sql("lineitem", "lineitem_staged_rows", "SELECT count(*) FROM lineitem", Q.FAIL_IF_EMPTY)])

NULL_CHECKS = {
    "null_nation_in_dim": ("c_nationkey IS NULL", Q.WARN_IF_ANY),
    "empty_name_in_dim": ("c_name IS NULL OR c_name = ''", Q.WARN_IF_ANY),
    "null_segment_in_dim": ("c_mktsegment IS NULL", Q.WARNING_IF_ANY),
    "renamed_customers": ("c_name LIKE '%-R'", Q.INFO),
}


def null_checks(spark, t):
    dim = _dim(spark, t).where("is_current")
    return Q.count_checks(dim, "customer", {k: (F.expr(c), r) for k, (c, r) in NULL_CHECKS.items()})


NULLS_SQL = " UNION ALL ".join(
    check_sql("customer", k, f"SELECT count(*) FILTER (WHERE {c}) FROM dim3 WHERE is_current", r)
    for k, (c, r) in NULL_CHECKS.items())


def orphan_checks(spark, t):
    dim = _dim(spark, t)
    return Q.suite(
        Q.orphan_count(t.orders, "o_custkey", dim, "c_custkey", "orders", "fact_orphan_customer",
                       parent_filter=F.col("is_current")),
        Q.orphan_count(t.lineitem, "l_orderkey", t.orders, "o_orderkey", "lineitem", "fact_orphan_order"),
        Q.orphan_count(t.lineitem.select((F.col("l_partkey") * 3).alias("k")), "k", t.part, "p_partkey",
                       "lineitem", "fact_orphan_part_shifted"))


ORPHANS_SQL = " UNION ALL ".join([
    check_sql("orders", "fact_orphan_customer",
              "SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM dim3 d WHERE d.c_custkey = o.o_custkey AND d.is_current)",
              Q.FAIL_IF_ANY),
    check_sql("lineitem", "fact_orphan_order",
              "SELECT count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)",
              Q.FAIL_IF_ANY),
    check_sql("lineitem", "fact_orphan_part_shifted",
              "SELECT count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey * 3)",
              Q.FAIL_IF_ANY)])


def duplicate_checks(spark, t):
    dim = _dim(spark, t)
    return Q.suite(
        Q.duplicate_count(dim.where("is_current"), ["c_custkey"], "customer", "duplicate_current_rows"),
        Q.duplicate_count(t.part, ["p_name"], "part", "duplicate_part_names", Q.WARN_IF_ANY),
        Q.duplicate_count(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem", "duplicate_fact_keys"))


DUPLICATES_SQL = " UNION ALL ".join([
    check_sql("customer", "duplicate_current_rows",
              "SELECT count(*) FROM (SELECT c_custkey FROM dim3 WHERE is_current GROUP BY c_custkey HAVING count(*) > 1)",
              Q.FAIL_IF_ANY),
    check_sql("part", "duplicate_part_names",
              "SELECT count(*) FROM (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1)", Q.WARN_IF_ANY),
    check_sql("lineitem", "duplicate_fact_keys",
              "SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)",
              Q.FAIL_IF_ANY)])


def variance_checks(spark, t):
    n = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    dim = _dim(spark, t)
    loaded = t.orders.join(dim.where("is_current").select(F.col("c_custkey").alias("o_custkey")), "o_custkey")
    urgent = t.orders.where(F.col("o_orderpriority") != "1-URGENT")
    return Q.suite(Q.variance(n(loaded), n(t.orders), "orders", "fact_vs_staging_variance"),
                   Q.variance(n(urgent), n(t.orders), "orders", "non_urgent_vs_staging_variance"))


def _variance_sql(mart, name, fact, stage):
    return (f"SELECT '{mart}' AS mart, '{name}' AS check_name, CAST(f AS BIGINT) AS row_count, "
            f"CASE WHEN abs(f - s) / CAST(nullif(s, 0) AS DOUBLE) < 0.01 THEN 'PASS' ELSE 'WARNING' END AS status, "
            f"CASE WHEN abs(f - s) / CAST(nullif(s, 0) AS DOUBLE) < 0.01 THEN 'INFO' ELSE 'WARNING' END AS severity "
            f"FROM (SELECT ({fact}) AS f, ({stage}) AS s) v")


VARIANCE_SQL = " UNION ALL ".join([
    _variance_sql("orders", "fact_vs_staging_variance",
                  "SELECT count(*) FROM orders o JOIN dim3 d ON d.c_custkey = o.o_custkey AND d.is_current",
                  "SELECT count(*) FROM orders"),
    _variance_sql("orders", "non_urgent_vs_staging_variance",
                  "SELECT count(*) FROM orders WHERE o_orderpriority <> '1-URGENT'", "SELECT count(*) FROM orders")])


def range_checks(spark, t):
    ind = enrolment_indicators(spark, t)
    sch = school_indicators(t)
    a = Q.count_checks(ind, "indicators", {
        "ger_outside_0_200": ((F.col("ger") < 0) | (F.col("ger") > 200), Q.WARN_IF_ANY),
        "enrolment_without_ger": ((F.col("enrolment") > 0) & F.col("ger").isNull(), Q.WARN_IF_ANY)})
    b = Q.count_checks(sch, "indicators", {
        "ptr_over_100": (F.col("ptr") > 100, Q.WARN_IF_ANY),
        "female_pct_outside_0_100": ((F.col("pct_female_teachers") < 0) | (F.col("pct_female_teachers") > 100),
                                     Q.FAIL_IF_ANY),
        "learners_without_teachers": ((F.col("learners") > 0) & F.col("teachers").isNull(),
                                      [("gt", 1000, "WARN")])})
    return Q.suite(a, b)


def _school_counts_sql(cond):
    return ("SELECT count(*) FILTER (WHERE " + cond + ") FROM (SELECT l.learners, t.teachers, "
            "CASE WHEN t.teachers > 0 THEN CAST((t.female_teachers * 200 * 100 + t.teachers) // (2 * t.teachers) AS DOUBLE) / 100 END AS pct_female_teachers, "
            "CASE WHEN t.teachers > 0 THEN CAST((l.learners * 200 + t.teachers) // (2 * t.teachers) AS DOUBLE) / 100 END AS ptr "
            "FROM (SELECT l_suppkey AS school, year(l_shipdate) AS y, count(*) AS learners FROM lineitem GROUP BY 1, 2) l "
            "LEFT JOIN (SELECT school, y, count(*) AS teachers, count(*) FILTER (WHERE l_partkey % 2 = 0) AS female_teachers "
            "FROM (SELECT DISTINCT l_suppkey AS school, year(l_shipdate) AS y, l_partkey FROM lineitem) d "
            "JOIN part p ON p.p_partkey = d.l_partkey GROUP BY 1, 2) t ON t.school = l.school AND t.y = l.y) s")


RANGES_SQL = f"WITH {ENROLMENT_SQL}\n" + " UNION ALL ".join([
    check_sql("indicators", "ger_outside_0_200", "SELECT count(*) FILTER (WHERE ger < 0 OR ger > 200) FROM ind",
              Q.WARN_IF_ANY),
    check_sql("indicators", "enrolment_without_ger",
              "SELECT count(*) FILTER (WHERE enrolment > 0 AND ger IS NULL) FROM ind", Q.WARN_IF_ANY),
    check_sql("indicators", "ptr_over_100", _school_counts_sql("ptr > 100"), Q.WARN_IF_ANY),
    check_sql("indicators", "female_pct_outside_0_100",
              _school_counts_sql("pct_female_teachers < 0 OR pct_female_teachers > 100"), Q.FAIL_IF_ANY),
    check_sql("indicators", "learners_without_teachers",
              _school_counts_sql("learners > 0 AND teachers IS NULL"), [("gt", 1000, "WARN")])])


def missing_checks(spark, t):
    dim = _dim(spark, t).where("is_current")
    return Q.suite(
        Q.missing_in_fact(dim, "c_custkey", t.orders, "o_custkey", "customer", "dim_without_fact",
                          [("gt", 1000, "WARN")]),
        Q.missing_in_fact(t.part, "p_partkey", t.lineitem, "l_partkey", "part", "subject_without_teacher"),
        Q.distinct_at_least(t.orders, "o_orderstatus", 2, "orders", "both_levels_present"))


MISSING_SQL = " UNION ALL ".join([
    check_sql("customer", "dim_without_fact",
              "SELECT count(*) FROM dim3 d WHERE d.is_current AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = d.c_custkey)",
              [("gt", 1000, "WARN")]),
    check_sql("part", "subject_without_teacher",
              "SELECT count(*) FROM part p WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey)",
              Q.WARN_IF_ANY),
    check_sql("orders", "both_levels_present", "SELECT count(DISTINCT o_orderstatus) FROM orders",
              [("lt", 2, "WARN")])])

_DIM_CTE = f"WITH {V.customer_dim_sql(3)}\n"


@query("dq_not_empty", sql=_DIM_CTE + NOT_EMPTY_SQL)
def q_dq_not_empty(spark, base):
    return not_empty_checks(spark, Tables(spark, base))


@query("dq_nulls", sql=_DIM_CTE + NULLS_SQL)
def q_dq_nulls(spark, base):
    """Null/empty counts over one table in a single aggregate."""
    return null_checks(spark, Tables(spark, base))


@query("dq_orphans", sql=_DIM_CTE + ORPHANS_SQL)
def q_dq_orphans(spark, base):
    return orphan_checks(spark, Tables(spark, base))


@query("dq_duplicates", sql=_DIM_CTE + DUPLICATES_SQL)
def q_dq_duplicates(spark, base):
    return duplicate_checks(spark, Tables(spark, base))


@query("dq_variance", sql=_DIM_CTE + VARIANCE_SQL)
def q_dq_variance(spark, base):
    return variance_checks(spark, Tables(spark, base))


@query("dq_ranges", sql=RANGES_SQL)
def q_dq_ranges(spark, base):
    return range_checks(spark, Tables(spark, base))


@query("dq_missing_in_fact", sql=_DIM_CTE + MISSING_SQL)
def q_dq_missing_in_fact(spark, base):
    return missing_checks(spark, Tables(spark, base))


def dq_suite(spark, t):
    return Q.suite(not_empty_checks(spark, t), null_checks(spark, t), orphan_checks(spark, t),
                   duplicate_checks(spark, t), variance_checks(spark, t), missing_checks(spark, t))


_SUITE_SQL = " UNION ALL ".join([NOT_EMPTY_SQL, NULLS_SQL, ORPHANS_SQL, DUPLICATES_SQL, VARIANCE_SQL, MISSING_SQL])


@query("dq_suite", sql=_DIM_CTE + _SUITE_SQL)
def q_dq_suite(spark, base):
    """All checks of the customer/order marts as one result table."""
    return dq_suite(spark, Tables(spark, base))


@query("dq_summary", sql=_DIM_CTE + f"""SELECT mart, count(*) AS checks,
  count(*) FILTER (WHERE status = 'PASS') AS passed,
  count(*) FILTER (WHERE status IN ('WARN', 'WARNING')) AS warnings,
  count(*) FILTER (WHERE status = 'FAIL') AS failed,
  count(*) FILTER (WHERE status = 'INFO') AS info
FROM ({_SUITE_SQL}) r GROUP BY mart""")
def q_dq_summary(spark, base):
    """E-S/T-S/N-S: per-mart tallies (raising is left to ``raise_on_fail``)."""
    return Q.summary(dq_suite(spark, Tables(spark, base)))

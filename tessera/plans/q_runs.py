"""Run-scoped logs and reports: staged enrolment extracts, the data-quality
log with its reports, and reports over the school snapshot fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import audit as A
from tessera.operators import quality as DQ
from tessera.operators.asof import asof_version
from tessera.operators.hierarchy import unit_to_district
from tessera.plans import eduviews as E
from tessera.plans import q_edu as Q
from tessera.plans import views as V
from tessera.plans.marts import schools as S
from tessera.plans.q_relational import HIERARCHY_BODY, units
from tessera.plans.registry import Tables, query
from tessera.sources.extract import append_rows

# ---------------------------------------------------------------------------
# Staged enrolments. Grades (id, name, level), levels (id, name,
# school type) and languages of the source system.
# ---------------------------------------------------------------------------
GRADES = [(1, "BABY CLASS", 1), (2, "P1", 2), (3, "P2", 2), (4, "S1", 3)]
LEVELS = [(1, "Nursery", 1), (2, "Primary level", 2), (3, "Secondary level", None)]
LANGUAGES = [(1, "English"), (2, "Luganda"), (3, "Swahili")]


@query("mart_enrolments_raw", sql=f"""WITH {E.ENROLMENTS_SQL}
SELECT * FROM learner_enrolments WHERE is_enrolment_active_yn""")
def q_mart_enrolments_raw(spark, base):
    """M-E0c / FLT-02: the active enrolments, every source column."""
    t = Tables(spark, base)
    return E.enrolments(t.orders, t.lineitem).where("is_enrolment_active_yn")


def _classes() -> list[tuple]:
    """(class id, name, label of its level): a level is called by its school
    type where it has one."""
    types = {k: name for k, name, *_ in E.SCHOOL_TYPES}
    labels = {k: types.get(kind, name).upper() for k, name, kind in LEVELS}
    return [(k, name, labels.get(level)) for k, name, level in GRADES]


@query("mart_enrolments_subtype", sql=f"""WITH {E.ENROLMENTS_SQL}, active AS (
  SELECT id AS enrolment_id, education_grade_id AS education_class_id, id % 4 AS familiar_language_id, date_created
  FROM learner_enrolments WHERE is_enrolment_active_yn)
SELECT active.*, class_name AS education_class_name, ifnull(label, 'UNKNOWN') AS school_level, language AS familiar_language_name
FROM active LEFT JOIN (FROM {E._values(_classes(), ['class_id', 'class_name', 'label'])}) ON education_class_id = class_id
LEFT JOIN (FROM {E._values(LANGUAGES, ['language_id', 'language'])}) ON familiar_language_id = language_id""")
def q_mart_enrolments_subtype(spark, base):
    """M-E0d / J-02: class, level and language of each active enrolment
    by code tables; the chain from class over level to school type is
    resolved once, on its few rows."""
    t = Tables(spark, base)
    named = lambda rows, cols: F.broadcast(spark.createDataFrame(rows, cols))
    classes = named(_classes(), "education_class_id long, education_class_name string, label string")
    langs = named(LANGUAGES, "familiar_language_id long, familiar_language_name string")
    e = E.enrolments(t.orders, t.lineitem).where("is_enrolment_active_yn").select(
        F.col("id").alias("enrolment_id"), F.col("education_grade_id").alias("education_class_id"),
        (F.col("id") % 4).alias("familiar_language_id"), "date_created")
    x = e.join(classes, "education_class_id", "left").join(langs, "familiar_language_id", "left")
    return x.select("enrolment_id", F.coalesce("label", F.lit("UNKNOWN")).alias("school_level"),
                    "education_class_id", "education_class_name", "familiar_language_id", "familiar_language_name", "date_created")


# ---------------------------------------------------------------------------
# Data-quality log: one append per run; old rows carry no result.
# ---------------------------------------------------------------------------
LOG_TIMES = {1: f"{Q.RUN1} 01:15:00", 2: f"{Q.RUN2} 01:15:00"}


def dq_log(spark, base) -> DataFrame:
    """AUD-4 / SNK-02 / AUD-7: each run's check results are appended to the
    log; rows written before ``result`` existed take their status."""
    rows = Q.dq_indicators(spark, Tables(spark, base))
    stamped = [rows.select(F.lit(run).cast("long").alias("run_id"), "mart", "check_name", "row_count", "status",
                           (F.lit(None).cast("string") if run == 1 else F.col("status")).alias("result"),
                           F.lit(at).cast("timestamp_ntz").alias("logged_at")) for run, at in LOG_TIMES.items()]
    return A.backfill_result(append_rows(spark, "dq_log", stamped))


DQ_LOG_SQL = f"""r AS ({Q.DQ_INDICATORS_SQL}),
log AS (""" + " UNION ALL ".join(
    f"SELECT CAST({run} AS BIGINT) AS run_id, mart, check_name, row_count, status, status AS result, TIMESTAMP '{at}' AS logged_at FROM r"
    for run, at in LOG_TIMES.items()) + ")"


@query("dq_log", sql=f"WITH {DQ_LOG_SQL}\nSELECT * FROM log")
def q_dq_log(spark, base):
    """AUD-4 / AUD-7: the appended log of two runs, results back-filled."""
    return dq_log(spark, base)


@query("report_recent_dq", sql=f"""WITH {DQ_LOG_SQL}
SELECT run_id, check_name, status, row_count, logged_at FROM log WHERE logged_at >= TIMESTAMP '{Q.RUN2} 00:00:00'
ORDER BY logged_at DESC, check_name""")
def q_report_recent_dq(spark, base):
    """RPT-1: check results logged since the latest business date, newest first."""
    since = F.lit(f"{Q.RUN2} 00:00:00").cast("timestamp_ntz")
    return dq_log(spark, base).where(F.col("logged_at") >= since).select(
        "run_id", "check_name", "status", "row_count", "logged_at").orderBy(F.col("logged_at").desc(), "check_name")


def _summary_sql(suite: str) -> str:
    return f"""SELECT mart, count(*) AS checks, count(*) FILTER (WHERE status = 'PASS') AS passed,
  count(*) FILTER (WHERE status IN ('WARN', 'WARNING')) AS warnings, count(*) FILTER (WHERE status = 'FAIL') AS failed,
  count(*) FILTER (WHERE status = 'INFO') AS info FROM ({suite}) r GROUP BY mart"""


@query("dq_summary_enrolment", sql=_summary_sql(Q.DQ_ENROL_SQL))
def q_dq_summary_enrolment(spark, base):
    """E-S: tallies of the enrolment mart's own suite."""
    return DQ.summary(Q.dq_enrolment(spark, Tables(spark, base)))


@query("dq_summary_teachers", sql=_summary_sql(Q.DQ_TEACHERS_SQL))
def q_dq_summary_teachers(spark, base):
    """T-S: tallies of the teachers mart's own suite."""
    return DQ.summary(Q.dq_teachers(spark, Tables(spark, base)))


@query("dq_summary_non_teaching_staff", sql=_summary_sql(Q.DQ_NTS_SQL))
def q_dq_summary_nts(spark, base):
    """N-S: tallies of the non-teaching staff mart's own suite."""
    return DQ.summary(Q.dq_nts(spark, Tables(spark, base)))


# ---------------------------------------------------------------------------
# Reports over the snapshot fact, the school versions of its date and the
# units they hang on.
# ---------------------------------------------------------------------------

def _school_star(spark, t) -> DataFrame:
    """The snapshot fact with the attributes valid on its date."""
    dim = Q.schools_dim(spark, t, 2)
    fact = S.school_fact(dim, Q.RUN2)
    return asof_version(fact, dim, "source_id", "source_id", "snapshot_date",
                        ["operational_status", "sex_composition", "admin_unit_id"], "school", how="inner")


_STAR_SQL = f"""{Q.schools_dim_sql(2)},
fact AS (SELECT source_id, DATE '{Q.RUN2}' AS snapshot_date FROM sdim2 WHERE is_current),
star AS (SELECT f.snapshot_date, d.operational_status, d.sex_composition, d.admin_unit_id
         FROM fact f JOIN sdim2 d ON d.source_id = f.source_id AND f.snapshot_date BETWEEN d.effective_date AND d.expiration_date)"""


@query("report_schools_by_status", sql=f"""WITH {_STAR_SQL}
SELECT snapshot_date, operational_status, count(*) AS schools FROM star GROUP BY ALL""")
def q_report_schools_by_status(spark, base):
    """RPT-5: schools by operational status on the snapshot's date."""
    return _school_star(spark, Tables(spark, base)).groupBy(
        "snapshot_date", F.col("school_operational_status").alias("operational_status")).agg(F.count(F.lit(1)).alias("schools"))


@query("report_schools_by_district", sql=f"""WITH {_STAR_SQL}, u2d AS ({HIERARCHY_BODY})
SELECT u.district_name, s.sex_composition, count(*) AS schools
FROM star s JOIN adim2 a ON a.id = s.admin_unit_id
JOIN u2d u ON u.unit_dim_id = a.source_id * 2 GROUP BY ALL""")
def q_report_schools_by_district(spark, base):
    """RPT-6 / HIR-01: schools by district and sex composition on a date; a
    school's unit leads to its district through the hierarchy."""
    t = Tables(spark, base)
    adim = Q.admin_dim(t, 2).select(F.col("id").alias("school_admin_unit_id"), (F.col("source_id") * 2).alias("unit_dim_id"))
    return (_school_star(spark, t).join(adim, "school_admin_unit_id").join(unit_to_district(units(t)), "unit_dim_id")
            .groupBy("district_name", F.col("school_sex_composition").alias("sex_composition")).agg(F.count(F.lit(1)).alias("schools")))

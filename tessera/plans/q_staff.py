"""Teachers and staff at their schools, and reports that name districts or one
run's steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.hierarchy import unit_to_district
from tessera.plans import eduviews as E
from tessera.plans import q_edu as Q
from tessera.plans.q_reports import _run_events, _runs_sql
from tessera.plans.q_stored import UNITS_NOW
from tessera.plans.registry import Tables, query

# What a flat row says about its school.
SCHOOL_COLUMNS = {"emis_number": "school_emis_number", "name": "school_name", "school_type": "school_type",
                  "ownership_status": "school_ownership"}
DISTRICTS_SQL = f"""units_now AS (SELECT id, source_id, admin_unit_type, name, child_id, is_current AS current_status FROM adim2),
u2d AS ({UNITS_NOW})"""
SCHOOLS_SQL = f"""{E.LOOKUPS_SQL}, {E.SUBTYPES_SQL}, {Q.schools_dim_sql(2, (Q.E_RUN1, Q.E_RUN2), shared=False)}, {DISTRICTS_SQL}"""


def _placed_sql(base: str, flat: str, name: str) -> str:
    columns = ", ".join(f"s.{c} AS {a}" for c, a in SCHOOL_COLUMNS.items())
    return f"""WITH {base}, {flat}, {SCHOOLS_SQL}
SELECT f.*, {columns}, s.admin_unit_id, u.district_name FROM {name} f
LEFT JOIN sdim2 s ON s.source_id = f.school_id AND s.is_current LEFT JOIN u2d u ON u.unit_dim_id = s.admin_unit_id"""


def districts_of(schools, units):
    """Current schools with their columns, admin unit and district."""
    now = schools.where("is_current").select(F.col("source_id").cast("long").alias("__school"), F.col("admin_unit_id").alias("unit_dim_id"),
                                             *[F.col(c).alias(a) for c, a in SCHOOL_COLUMNS.items()])
    return now.join(unit_to_district(units).select("unit_dim_id", "district_name"), "unit_dim_id", "left") \
              .withColumnRenamed("unit_dim_id", "admin_unit_id")


def placed(flat, schools, units):
    """M-T1 / M-N1: flat rows with the name, type, ownership, unit and district
    of their school; rows of unknown schools stay."""
    at = districts_of(schools, units)
    return flat.join(at, flat["school_id"].cast("long") == at["__school"], "left").drop("__school")


def _schools_and_units(spark, t):
    runs = (Q.E_RUN1, Q.E_RUN2)
    return Q.schools_dim(spark, t, 2, runs), Q.admin_dims(t, 2, runs)[-1]


@query("mart_teachers_placed", sql=_placed_sql(Q.T_BASE_SQL, Q.teachers_flat_sql(2, Q.T_RUN2), "tflat2"))
def q_mart_teachers_placed(spark, base):
    """M-T0a / M-T1: teacher x school x term of run 2 with the school's columns."""
    t = Tables(spark, base)
    return placed(Q.teachers_flat(spark, t, 2, Q.T_RUN2), *_schools_and_units(spark, t))


@query("mart_nts_placed", sql=_placed_sql(Q.N_BASE_SQL, Q.nts_flat_sql(2, Q.T_RUN2), "nflat2"))
def q_mart_nts_placed(spark, base):
    """M-N0 / M-N1: staff x term of run 2 with the school's columns."""
    t = Tables(spark, base)
    return placed(Q.nts_flat(spark, t, 2, Q.T_RUN2), *_schools_and_units(spark, t))


@query("report_infrastructure_districts", sql=f"""WITH {Q.INFRA_FACT_SQL}, {DISTRICTS_SQL}
SELECT u.district_name, f.infra_type_name, f.structure_condition, f.gender_usage, count(*) AS structures,
       CAST(sum(f.total_number) AS BIGINT) AS total_number
FROM ifact f LEFT JOIN sdim2 s ON s.source_id = f.school_id AND s.is_current LEFT JOIN u2d u ON u.unit_dim_id = s.admin_unit_id
GROUP BY ALL""")
def q_report_infrastructure_districts(spark, base):
    """RPT-10: structures by district, type, condition and who uses them."""
    t = Tables(spark, base)
    at = districts_of(Q.schools_dim(spark, t, 2), Q.admin_dims(t, 2)[-1]).select("__school", "district_name")
    # reduced to groups per school before the district is looked up
    kinds = ["infra_type_name", "structure_condition", "gender_usage"]
    per_school = Q.infra_fact(spark, t).groupBy(F.col("school_id").cast("long").alias("__school"), *kinds).agg(
        F.count(F.lit(1)).alias("structures"), F.sum("total_number").alias("total_number"))
    return per_school.join(at, "__school", "left").groupBy("district_name", *kinds).agg(
        F.sum("structures").alias("structures"), F.sum("total_number").cast("long").alias("total_number"))


# The order of a run's steps.
STEP_ORDER = {"extract": 1, "scd2": 2}


@query("report_run_steps", sql=_runs_sql() + """
, last AS (SELECT * FROM runs WHERE started_at = (SELECT max(started_at) FROM runs))
SELECT run_id, 1 AS step_no, 'extract' AS step, 'SUCCESS' AS status, raw_rows AS rows FROM last
UNION ALL SELECT run_id, 2, 'scd2', 'SUCCESS', new_versions FROM last ORDER BY step_no""")
def q_report_run_steps(spark, base):
    """RPT-3: the latest run's steps with their row counts, in order."""
    _, steps = _run_events(spark, base)
    last = steps.agg(F.max(F.struct("event_time", "run_id"))["run_id"].alias("run_id"))
    place = F.coalesce(*[F.when(F.col("step") == s, F.lit(n)) for s, n in STEP_ORDER.items()])
    return steps.join(last, "run_id").select("run_id", place.alias("step_no"), "step", "status", "rows").orderBy("step_no")

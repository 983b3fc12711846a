"""Teacher transfers with their places and teachers, and the flow between
districts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans import eduviews as E
from tessera.plans import q_edu as Q
from tessera.plans.marts import teachers as TE
from tessera.plans.marts import transfers as X
from tessera.plans.registry import Tables, query

_PLACES = ", ".join(f"{r[:3]}_s.name AS {r}_school_name, {r[:3]}_t.name AS {r}_school_type, {r[:3]}_d.id AS {r}_district_id, {r[:3]}_d.name AS {r}_district_name"
                    for r in X.ROLES)
_JOINS = "\n".join(f"""LEFT JOIN sraw2 {r[:3]}_s ON {r[:3]}_s.id = x.{r}_school_id LEFT JOIN setting_school_types {r[:3]}_t ON {r[:3]}_t.id = {r[:3]}_s.school_type_id
LEFT JOIN seats {r[:3]}_d ON {r[:3]}_d.government = x.{r}_local_government_id""" for r in X.ROLES)
TRANSFERS_RAW_SQL = f"""{Q.T_BASE_SQL}, {Q.teachers_flat_sql(2, Q.T_RUN2)}, {E.LOOKUPS_SQL}, {E.schools_raw_sql(2, 'sraw2')}, {E.TEACHER_TRANSFERS_SQL},
seats AS (SELECT n_nationkey AS government, CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM nation, region
          WHERE n_regionkey = r_regionkey AND n_nationkey % 8 <> 7 AND r_regionkey <> 4),
posted AS (SELECT DISTINCT l_partkey + {E.TEACHER_OFFSET} AS p, l_suppkey AS s, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_linenumber % 4 IN (1, 2)),
moved AS (SELECT t.*, CAST(t.posting_date - posted.d AS INTEGER) AS days FROM teacher_transfers t
          ASOF LEFT JOIN posted ON posted.p = t.person_id AND posted.s = t.outgoing_school_id AND t.posting_date > posted.d),
xfers AS (SELECT {', '.join('x.' + c for c in X.SOURCE)}, {_PLACES}, coalesce(out_d.id <> inc_d.id, FALSE) AS is_inter_district,
    CASE x.status WHEN 1 THEN 'PENDING' WHEN 2 THEN 'APPROVED' WHEN 3 THEN 'REJECTED' ELSE 'UNKNOWN' END AS transfer_status,
    x.days AS days_at_outgoing_station, {', '.join('w.' + c for c in X.TEACHER)},
    CASE WHEN k.total_subjects > 0 THEN CASE k.science_count WHEN k.total_subjects THEN 'SCIENCE' WHEN 0 THEN 'ARTS' ELSE 'BOTH' END END AS discipline
  FROM moved x
{_JOINS}
LEFT JOIN traw2 w ON w.person_id = x.person_id LEFT JOIN tcounts k ON k.person_id = x.person_id)"""


def transfers_raw(spark, t):
    lk = {**E.lookups(spark), **E.enrolment_lookups(spark), **E.teacher_lookups(spark), **E.employment_lookups(spark)}
    people = TE.teachers_raw(E.teachers_src(t.part, 2), E.school_employees(t.lineitem), E.teacher_documents(t.lineitem), t.nation, lk)
    people = X.teachers_and_counts(people, E.teacher_subjects(t.lineitem))      # first: its shuffles go before transfers are stored
    return X.transfers_of(E.teacher_transfers(t.lineitem), E.schools_raw(t.supplier, t.nation, 2), lk["setting_school_types"],
                          E.local_governments(t.nation), E.districts(t.region), E.teacher_postings(t.lineitem), people)


@query("mart_transfers_raw", sql=f"WITH {TRANSFERS_RAW_SQL}\nSELECT * FROM xfers")
def q_mart_transfers_raw(spark, base):
    """M-X0 / J-07 / J-18 / D-13 / D-14 / D-16: every transfer with both schools
    and districts (by local government), the teacher and the discipline."""
    return transfers_raw(spark, Tables(spark, base))


@query("report_transfer_districts", sql=f"""WITH {TRANSFERS_RAW_SQL}
SELECT outgoing_district_name, incoming_district_name, discipline, count(*) AS transfers, count(DISTINCT person_id) AS teachers,
       count(*) FILTER (WHERE is_inter_district) AS inter_district, CAST(sum(days_at_outgoing_station) AS BIGINT) AS days_at_station
FROM xfers WHERE transfer_status = 'APPROVED' GROUP BY ALL""")
def q_report_transfer_districts(spark, base):
    """RPT-8: approved flow from district to district by discipline."""
    x = transfers_raw(spark, Tables(spark, base)).where(F.col("transfer_status") == "APPROVED")
    keys = ["outgoing_district_name", "incoming_district_name", "discipline"]
    # one row per teacher and flow first: no distinct over the rows of a few large flows
    each = x.groupBy(*keys, "person_id").agg(F.count(F.lit(1)).alias("transfers"), F.count_if("is_inter_district").alias("inter_district"),
                                             F.sum("days_at_outgoing_station").alias("days_at_station"))
    return each.groupBy(*keys).agg(F.sum("transfers").alias("transfers"), F.count(F.lit(1)).alias("teachers"),
                                   F.sum("inter_district").alias("inter_district"), F.sum("days_at_station").alias("days_at_station"))

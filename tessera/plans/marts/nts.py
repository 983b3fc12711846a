"""Non-teaching staff mart: raw -> flat (staff x term) -> SCD2 -> fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.operators import scd2
from tessera.operators.dedupe import pick_one
from tessera.operators.facts import load_fact_earliest
from tessera.operators.joins import expand_over
from tessera.plans.marts.teachers import decoded, employment, last_terms
from tessera.session import materialize

# The columns whose change opens a staff version; the others are carried.
NTS_TRACKED = ["gender", "staff_category", "staff_role", "highest_education_level", "employment_status", "is_on_government_payroll"]
NTS_EXTRA = ["surname", "given_name", "nationality", "nin", "ipps_number", "hrin", "school_id"]
FACT_KEY = ["person_id", "school_id", "academic_year", "term"]


def nts_raw(src: DataFrame, employees: DataFrame, countries: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """M-N0: each staff row with the employee record it names, one row per
    person (the record updated last); school from the record else the staff
    row's current school; off the payroll where no record says otherwise."""
    x = decoded(src, "non_teaching_staff_category_id", lookups["setting_non_teaching_staff_categories"], "staff_category")
    x = decoded(x, "non_teaching_staff_role_id", lookups["setting_non_teaching_staff_roles"], "staff_role")
    c = countries.select(F.col("n_nationkey").cast("long").alias("country_id"), F.col("n_name").alias("__country"))
    x = x.join(c, "country_id", "left").join(employment(employees, lookups, "employee_id"), "employee_id", "left")
    x = x.select("person_id", "employee_id", "surname", rules.given_name("first_name", F.lit(None).cast("string")).alias("given_name"),
                 "gender", "birth_date", rules.nationality("__country").alias("nationality"), F.col("id_number").alias("nin"),
                 "staff_category", "staff_role", "appointment_date", "highest_education_level", "employment_status",
                 F.coalesce("__e_payroll", F.lit(False)).alias("is_on_government_payroll"), F.col("__e_ipps").alias("ipps_number"), "hrin",
                 F.coalesce("__e_school", "current_school_id").alias("school_id"), "date_updated")
    return pick_one(x, ["person_id"], [("date_updated", "desc", "last"), ("employee_id", "desc", "last")],
                    [c for c in x.columns if c not in ("person_id", "date_updated", "employee_id")] + ["employee_id"])


def flatten_nts(raw: DataFrame, calendar: DataFrame, years: DataFrame, periods: DataFrame, as_of, last: bool = False) -> DataFrame:
    """M-N1 / J-04 / CAL-02: every staff member with a school x each active
    global term, the calendar deduplicated first (no 4x duplication). With
    ``last`` only the latest of these terms, for a snapshot."""
    act = calendar.where((F.col("status") == "active") & F.col("school_id").isNull())
    one = pick_one(act, ["academic_year_id", "teaching_period_id"], [("school_type_id", "asc"), ("id", "asc")],
                   ["start_date"])
    named = (one.join(F.broadcast(years.select(F.col("id").alias("academic_year_id"), F.col("name").alias("__ay"))),
                      "academic_year_id")
                .join(F.broadcast(periods.select(F.col("id").alias("teaching_period_id"),
                                                 F.col("name").alias("__tp"))), "teaching_period_id")
                .select(rules.academic_year("__ay", "start_date").alias("academic_year"),
                        rules.term_label("__tp").alias("term"), F.col("start_date").alias("term_start_date")))
    if last:
        named = last_terms(named.withColumn("cal_school", F.lit(None).cast("long"))).drop("cal_school")
    staff = raw.where(F.col("school_id").isNotNull())
    x = expand_over(staff, named)
    day = F.to_date(F.lit(as_of))
    return x.select("person_id", "school_id", "academic_year", "term", "term_start_date", "surname", "given_name",
                    "gender", F.when(F.col("birth_date").isNotNull(), rules.age_years("birth_date", day)).alias("age"),
                    "nationality", "nin", "staff_category", "staff_role", "appointment_date", "employee_id", "highest_education_level",
                    "employment_status", "is_on_government_payroll", "ipps_number", "hrin")


def nts_dim(dim: DataFrame | None, flat: DataFrame, as_of) -> DataFrame:
    """M-N2: one row per staff member (latest term), SCD2 merge."""
    snap = pick_one(flat, ["person_id"], [("term_start_date", "desc", "last"), ("school_id", "desc")], NTS_TRACKED + NTS_EXTRA)
    if dim is None:
        dim = scd2.empty_dim(flat.sparkSession, snap, ["person_id"] + NTS_TRACKED + NTS_EXTRA)
    return materialize(scd2.scd2_merge(dim, snap, ["person_id"], NTS_TRACKED, as_of, extra=NTS_EXTRA), "nts_dim")


def nts_fact(flat: DataFrame, staff: DataFrame, schools: DataFrame) -> DataFrame:
    """M-N3 / FCT-03: earliest staff and school versions (no as-of attempt)."""
    f = flat.withColumn("school_key", F.col("school_id").cast("long"))
    dims = [dict(dim=staff, fact_key="person_id", dim_key="person_id", take=["effective_date"], prefix="nv"),
            dict(dim=schools, fact_key="school_key", dim_key="source_id", take=["effective_date"], prefix="sv")]
    out = load_fact_earliest(f, dims)
    one = pick_one(out, FACT_KEY, [("term_start_date", "asc")],
                   ["term_start_date", "nv_effective_date", "sv_effective_date", "staff_role"])
    return one.select(*FACT_KEY, "term_start_date", F.col("nv_effective_date").alias("staff_version"),
                      F.col("sv_effective_date").alias("school_version"), "staff_role")

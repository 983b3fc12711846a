"""Teachers mart: raw -> current school -> flat (teacher x school x term) ->
teacher SCD2 -> HR fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.operators import scd2
from tessera.operators.dedupe import pick_each, pick_one
from tessera.operators.facts import load_fact_fallback
from tessera.operators.joins import or_join_terms, sized
from tessera.plans.marts.enrolment import IDENTITY_PATTERNS, pivoted_documents
from tessera.session import materialize

# The columns whose change opens a teacher version; the others are carried.
TEACHER_TRACKED = ["gender", "qualification", "qualification_category", "teacher_type", "designation", "highest_education_level",
                   "is_on_government_payroll", "discipline"]
TEACHER_EXTRA = ["surname", "given_name", "nationality", "nin", "passport_no", "ipps_number", "hrin", "employment_status"]
TEACHER_DOCUMENTS = {n: IDENTITY_PATTERNS[n] for n in ("nin", "passport_no")}
FACT_KEY = ["person_id", "school_id", "academic_year", "term"]


def decoded(rows: DataFrame, key: str, lookup: DataFrame, name: str, *more: str) -> DataFrame:
    """``rows`` with the name (and further columns) of a fixed code table."""
    codes = lookup.select(F.col("id").alias(key), F.col("name").alias(name), *more)
    return rows.join(F.broadcast(codes), key, "left")


def employment(employees: DataFrame, lookups: dict[str, DataFrame], key: str) -> DataFrame:
    """Employee records with their code tables resolved; ``key`` becomes the
    column to join by, the columns that a person may have too get ``__e_``."""
    x = decoded(employees, "highest_education_level_id", lookups["setting_education_levels"], "highest_education_level")
    x = decoded(x, "employment_status_id", lookups["setting_employment_statuses"], "employment_status")
    keep = ["employee_id", "hrin", "weekly_teaching_periods", "highest_education_level", "employment_status", "date_updated"]
    x = x.withColumn("employee_id", F.col("id"))
    return x.select(F.col(key), *[c for c in keep if c != key], F.col("school_id").alias("__e_school"),
                    F.col("ipps_number").alias("__e_ipps"), F.col("is_on_government_payroll").alias("__e_payroll"))


def teachers_raw(src: DataFrame, employees: DataFrame, docs: DataFrame, countries: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """M-T0a: names, nationality, identity documents and decoded attributes,
    with the employee record updated last; its payroll number and flag count
    where the teacher has none."""
    return with_records(src, latest_record(employees, lookups),
                        pivoted_documents(docs, lookups["setting_identity_document_types"], TEACHER_DOCUMENTS), countries, lookups)


RECORD_ORDER = [("date_updated", "desc", "last"), ("id", "desc")]
RECORD_COLUMNS = ["highest_education_level_id", "employment_status_id", "hrin", "weekly_teaching_periods", "ipps_number",
                  "is_on_government_payroll", "id", "date_updated", "school_id"]
POSTING_ORDER = [("date_started", "desc", "last"), ("school_id", "desc")]


def latest_record(employees: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """One row per person: the employee record updated last. Its code tables
    are resolved after the pick."""
    return _resolved(pick_one(employees, ["person_id"], RECORD_ORDER, RECORD_COLUMNS), lookups)


def _resolved(records: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    return employment(records, lookups, "person_id").drop("date_updated", "__e_school")


def records_and_schools(employees: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """Per known person the record updated last (``latest_record``) and the
    school of the latest posting (``current_school``), in one aggregate."""
    both = pick_each(employees.where(F.col("person_id").isNotNull()), ["person_id"],
                     {"record": (RECORD_ORDER, RECORD_COLUMNS), "posting": (POSTING_ORDER, ["school_id"])})
    # The posting's school goes along as a field that the record doesn't have.
    records = both.select("person_id", *[F.col(f"record.{c}").alias(c) for c in RECORD_COLUMNS if c != "school_id"],
                          F.col("posting.school_id").alias("school_id"))
    return employment(records, lookups, "person_id").drop("date_updated").withColumnRenamed("__e_school", "school_id")


def with_records(src: DataFrame, latest: DataFrame, documents: DataFrame, countries: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """M-T0a from one employee record and one row of documents per person."""
    x = decoded(src, "teacher_type_id", lookups["setting_teacher_types"], "teacher_type")
    x = decoded(x, "qualification_id", lookups["setting_teacher_professional_qualifications"], "qualification", "qualification_category")
    x = decoded(x, "designation_id", lookups["setting_teaching_staff_designations"], "designation")
    c = countries.select(F.col("n_nationkey").cast("long").alias("country_id"), F.col("n_name").alias("__country"))
    x = x.join(c, "country_id", "left").join(latest, "person_id", "left").join(documents, "person_id", "left")
    return x.select("person_id", "employee_id", "surname", rules.given_name("first_name", "other_names").alias("given_name"),
                    "gender", "birth_date", rules.nationality("__country").alias("nationality"), *TEACHER_DOCUMENTS,
                    "teacher_type", "qualification", "qualification_category", "designation",
                    F.coalesce("ipps_number", "__e_ipps").alias("ipps_number"),
                    F.coalesce("is_on_government_payroll", "__e_payroll").alias("is_on_government_payroll"),
                    "highest_education_level", "employment_status", "hrin", "weekly_teaching_periods")


def current_school(employees: DataFrame) -> DataFrame:
    """M-T0c: the latest posting per teacher (ties: larger school id)."""
    return pick_one(employees, ["person_id"], POSTING_ORDER, ["school_id", "date_started"])


def discipline_counts(subjects: DataFrame) -> DataFrame:
    """M-T0b + AGG-02: subjects and science subjects per teacher."""
    return subjects.groupBy("person_id").agg(F.count(F.lit(1)).alias("total_subjects"),
                                             F.count_if(F.col("is_science_subject")).alias("science_count"))


def flatten_teachers(raw: DataFrame, school: DataFrame, calendar: DataFrame, years: DataFrame,
                     periods: DataFrame, counts: DataFrame, as_of) -> DataFrame:
    """M-T1: teacher x current school x active term (global terms for all,
    plus the school's own terms; the calendar is deduplicated first)."""
    return over_terms(staffed(raw, school, counts), calendar, years, periods, as_of)


def staffed(raw: DataFrame, school: DataFrame, counts: DataFrame) -> DataFrame:
    """Teacher x current school with the subject counts, before the terms."""
    return raw.join(school, "person_id").join(counts, "person_id", "left")


def active_calendar(calendar: DataFrame) -> DataFrame:
    """The deduplicated active terms; ``cal_school`` is null where they count for all."""
    act = calendar.where(F.col("status") == "active")
    glob = pick_one(act.where(F.col("school_id").isNull()), ["academic_year_id", "teaching_period_id"],
                    [("school_type_id", "asc"), ("id", "asc")], ["start_date", "school_id"])
    own = pick_one(act.where(F.col("school_id").isNotNull()),
                   ["academic_year_id", "teaching_period_id", "school_id"],
                   [("school_type_id", "asc"), ("id", "asc")], ["start_date"])
    return glob.unionByName(own).select("academic_year_id", "teaching_period_id", "start_date",
                                        F.col("school_id").alias("cal_school"))


def labelled(rows: DataFrame, years: DataFrame, periods: DataFrame) -> DataFrame:
    """Rows of a known year and period, with the labels of their term."""
    named = (rows.join(F.broadcast(years.select(F.col("id").alias("academic_year_id"), F.col("name").alias("__ay"))),
                      "academic_year_id")
                .join(F.broadcast(periods.select(F.col("id").alias("teaching_period_id"), F.col("name").alias("__tp"))),
                      "teaching_period_id"))
    return named.select(*[c for c in rows.columns if c not in ("academic_year_id", "teaching_period_id", "start_date")],
                        rules.academic_year("__ay", "start_date").alias("academic_year"), rules.term_label("__tp").alias("term"),
                        F.col("start_date").alias("term_start_date"))


def last_terms(terms: DataFrame) -> DataFrame:
    """The latest of the terms that count for all and of each school's own.

    A snapshot takes a person's latest term, and nothing that it keeps of a row
    depends on the term: the maximum over the fan-out is the larger of these
    two, so the calendar is reduced before the fan-out instead of after it."""
    return pick_one(terms, ["cal_school"], [("term_start_date", "desc", "last")], ["academic_year", "term", "term_start_date"])


def over_terms(ts: DataFrame, calendar: DataFrame, years: DataFrame, periods: DataFrame, as_of, last: bool = False) -> DataFrame:
    """Every staffed teacher x active term: the fan-out of M-T1, row by row.
    With ``last`` only over ``last_terms``, for a snapshot of the latest term."""
    cal = active_calendar(calendar)
    if last:
        x = or_join_terms(ts, last_terms(labelled(cal, years, periods)), "school_id", "cal_school")
    else:
        x = labelled(or_join_terms(ts, cal, "school_id", "cal_school"), years, periods)
    day = F.to_date(F.lit(as_of))
    return x.select(
        "person_id", "school_id", "academic_year", "term", "term_start_date",
        "surname", "given_name", "gender",
        F.when(F.col("birth_date").isNotNull(), rules.age_years("birth_date", day)).alias("age"),
        "nationality", *TEACHER_DOCUMENTS, "teacher_type", "qualification", "qualification_category", "designation",
        "ipps_number", "is_on_government_payroll", "employee_id", "highest_education_level", "employment_status", "hrin",
        "weekly_teaching_periods",
        "total_subjects", "science_count",
        rules.discipline("science_count", "total_subjects").alias("discipline"))


def teacher_dim(dim: DataFrame | None, flat: DataFrame, as_of) -> DataFrame:
    """M-T2: one row per teacher (latest term, then school), SCD2 merge."""
    snap = pick_one(flat, ["person_id"], [("term_start_date", "desc", "last"), ("school_id", "desc")],
                    TEACHER_TRACKED + TEACHER_EXTRA)
    if dim is None:
        dim = scd2.empty_dim(flat.sparkSession, snap, ["person_id"] + TEACHER_TRACKED + TEACHER_EXTRA)
    return materialize(scd2.scd2_merge(dim, snap, ["person_id"], TEACHER_TRACKED, as_of, extra=TEACHER_EXTRA), "teacher_dim")


def hr_fact(flat: DataFrame, teachers: DataFrame, schools: DataFrame, closed: bool = True) -> DataFrame:
    """M-T3: as-of teacher and school versions at the term start with the
    all-or-nothing earliest fallback; one row per conflict key."""
    f = flat.withColumn("school_key", F.col("school_id").cast("long"))
    dims = [dict(dim=teachers, fact_key="person_id", dim_key="person_id", take=["effective_date"], prefix="tv"),
            dict(dim=schools, fact_key="school_key", dim_key="source_id", take=["effective_date"], prefix="sv")]
    loaded = load_fact_fallback(f, dims, "term_start_date", closed=closed)
    keep = ["term_start_date", "tv_effective_date", "sv_effective_date", "resolution", "discipline"]
    one = pick_one(loaded, FACT_KEY, [("term_start_date", "asc"), ("tv_effective_date", "asc"),
                                      ("sv_effective_date", "asc")], keep)
    return one.select(*FACT_KEY, "term_start_date", F.col("tv_effective_date").alias("teacher_version"),
                      F.col("sv_effective_date").alias("school_version"), "resolution", "discipline")

"""Enrolment mart: learners_raw -> enrolments_flat -> learner_dim -> enrolment_fact."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.operators import scd2
from tessera.operators.dedupe import pick_one
from tessera.operators.facts import load_fact_fallback
from tessera.session import materialize

# Identity-document and disability patterns (case-folded LIKE,
# any of a list), and the columns whose change opens a learner version.
IDENTITY_PATTERNS = {
    "nin": ["%NATIONAL%", "%NIN%"],
    "passport_no": ["%PASSPORT%"],
    "student_pass_no": ["%STUDENT%PASS%"],
    "work_permit_no": ["%WORK%PERMIT%"],
    "refugee_id": ["%REFUGEE%"],
}
DISABILITY_PATTERNS = {
    "is_visual_yn": ["%VISUAL%"],
    "is_hearing_yn": ["%HEARING%"],
    "is_walking_yn": ["%WALK%", "%MOBIL%"],
    "is_self_care_yn": ["%SELF%CARE%"],
    "is_remembering_yn": ["%REMEMBER%", "%CONCENTRAT%", "%COGNIT%"],
    "is_communication_yn": ["%COMMUNIC%"],
}
LEARNER_TRACKED = ["gender", "nationality", "nin", "orphan_status", *DISABILITY_PATTERNS, "has_multiple_disabilities"]
LEARNER_EXTRA = ["surname", "given_name", "birth_date", "lin"]
FACT_KEY = ["learner_id", "school_id", "academic_year", "term"]


def like_any(col, patterns: list[str]):
    """True where ``col`` matches any of the LIKE patterns."""
    return functools.reduce(operator.or_, [col.like(p) for p in patterns])


def pivoted_documents(docs: DataFrame, doc_types: DataFrame, patterns: dict) -> DataFrame:
    """One row per person with such a document: the largest document id of each
    kind. Types of no kind are left out before the aggregate."""
    t = F.broadcast(doc_types.select(F.col("id").alias("identity_type_id"), F.upper("name").alias("__t"))
                    .where(like_any(F.col("__t"), [p for of in patterns.values() for p in of])))
    return docs.join(t, "identity_type_id").groupBy("person_id").agg(
        *[F.max(F.when(like_any(F.col("__t"), p), F.col("document_id"))).alias(n) for n, p in patterns.items()])


def learners_raw(persons: DataFrame, learners: DataFrame, docs: DataFrame, doc_types: DataFrame,
                 countries: DataFrame) -> DataFrame:
    """M-E0a: live learners with names, nationality and pivoted identity documents."""
    piv = pivoted_documents(docs, doc_types, IDENTITY_PATTERNS)
    live = learners.where(F.col("deleted_at").isNull())
    c = countries.select(F.col("n_nationkey").cast("long").alias("country_id"), F.col("n_name").alias("__country"))
    x = (persons.join(live, persons["id"] == live["person_id"])
                .join(c, "country_id", "left")
                .join(piv, "person_id", "left"))
    return x.select("person_id", "lin", "surname", rules.given_name("first_name", "other_names").alias("given_name"),
                    "gender", "birth_date", rules.nationality("__country").alias("nationality"),
                    *IDENTITY_PATTERNS.keys(), "is_mother_dead", "is_father_dead")


def disability_flags(disabilities: DataFrame, types: DataFrame) -> DataFrame:
    """AGG-05: one BOOL_OR flag per pattern and learner (a partial aggregate)."""
    t = F.broadcast(types.select(F.col("id").alias("disability_type_id"), F.upper("name").alias("__t")))
    return disabilities.join(t, "disability_type_id").groupBy("learner_id").agg(
        *[F.bool_or(like_any(F.col("__t"), p)).alias(n) for n, p in DISABILITY_PATTERNS.items()])


def flatten_enrolments(enrol: DataFrame, learners_raw_: DataFrame, schools_raw: DataFrame,
                       subtypes: dict[str, DataFrame], years: DataFrame, periods: DataFrame,
                       enrol_types: DataFrame, flags: DataFrame, ownership_names: DataFrame, as_of) -> DataFrame:
    """M-E1: one row per active enrolment with every derived learner and school rule."""
    e = enrol.where(F.col("is_enrolment_active_yn"))
    s = schools_raw.select(F.col("id").alias("school_id"), "has_female_students", "has_male_students",
                           "is_government_owned_yn", "school_ownership_status_id", "parish_id", "sub_county_id",
                           "county_id", "district_id", "region_id")
    x = (e.join(learners_raw_, e["learner_id"] == learners_raw_["person_id"])
          .join(s, "school_id")
          .join(flags, "learner_id", "left"))
    for name, st in subtypes.items():
        x = x.join(st.select(F.col("school_id").alias(f"{name}_sid"),
                             F.col("admits_day_scholars_yn").alias(f"{name}_day"),
                             F.col("admits_boarders_yn").alias(f"{name}_board")),
                   F.col("school_id") == F.col(f"{name}_sid"), "left")
    x = (x.join(F.broadcast(years.select(F.col("id").alias("academic_year_id"), F.col("name").alias("__ay"))),
                "academic_year_id", "left")
          .join(F.broadcast(periods.select(F.col("id").alias("teaching_period_id"), F.col("name").alias("__tp"))),
                "teaching_period_id", "left")
          .join(F.broadcast(enrol_types.select(F.col("id").alias("enrolment_type_id"), F.col("name").alias("__et"))),
                "enrolment_type_id", "left")
          .join(F.broadcast(ownership_names.select(F.col("id").alias("school_ownership_status_id"),
                                                   F.col("name").alias("__own"))),
                "school_ownership_status_id", "left"))
    day = F.to_date(F.lit(as_of))
    flag_cols = [F.coalesce(F.col(n), F.lit(False)).alias(n) for n in DISABILITY_PATTERNS]
    trip = lambda n: (f"{n}_sid", f"{n}_day", f"{n}_board")
    out = x.select(
        F.col("id").alias("enrolment_id"), "learner_id", "school_id",
        rules.academic_year("__ay", "date_created").alias("academic_year"),
        rules.term_label("__tp").alias("term"),
        F.col("education_grade_id").alias("grade_id"),
        rules.enrolment_type("__et").alias("enrolment_type"),
        "surname", "given_name", "gender", "birth_date", "nationality", "nin", "lin",
        F.when(F.col("birth_date").isNotNull(), rules.age_years("birth_date", day)).alias("age"),
        rules.orphan_status("is_mother_dead", "is_father_dead").alias("orphan_status"),
        *flag_cols,
        rules.sex_composition("has_female_students", "has_male_students").alias("sex_composition"),
        rules.boarding_status([trip(n) for n in subtypes]).alias("boarding_status"),
        rules.ownership("__own", "is_government_owned_yn").alias("ownership_status"),
        F.coalesce("parish_id", "sub_county_id", "county_id", "district_id", "region_id")
         .alias("admin_unit_source_id"))
    return out.withColumn("has_multiple_disabilities", rules.multiple_flags(*DISABILITY_PATTERNS.keys()))


def learner_dim(dim: DataFrame | None, flat: DataFrame, as_of) -> DataFrame:
    """M-E2: one row per learner (oldest age first, then the latest enrolment),
    merged as SCD2; each run's dimension is stored once."""
    snap = pick_one(flat, ["learner_id"], [("age", "desc", "last"), ("enrolment_id", "desc")], LEARNER_TRACKED + LEARNER_EXTRA)
    if dim is None:
        dim = scd2.empty_dim(flat.sparkSession, snap, ["learner_id"] + LEARNER_TRACKED + LEARNER_EXTRA)
    return materialize(scd2.scd2_merge(dim, snap, ["learner_id"], LEARNER_TRACKED, as_of, extra=LEARNER_EXTRA), "learner_dim")


def enrolment_fact(flat: DataFrame, learners: DataFrame, schools: DataFrame, closed: bool = True) -> DataFrame:
    """M-E3: fixed term start dates, as-of learner and school versions with the
    all-or-nothing earliest fallback, one row per conflict key (first
    enrolment id wins, as with insert-if-absent in id order)."""
    f = flat.withColumn("term_start_date", rules.term_start_date(F.col("academic_year"), F.col("term"))) \
            .withColumn("school_key", F.col("school_id").cast("long"))
    dims = [dict(dim=learners, fact_key="learner_id", dim_key="learner_id", take=["effective_date"], prefix="lv"),
            dict(dim=schools, fact_key="school_key", dim_key="source_id", take=["effective_date"], prefix="sv")]
    loaded = load_fact_fallback(f, dims, "term_start_date", closed=closed)
    cols = ["enrolment_id", "term_start_date", "lv_effective_date", "sv_effective_date", "resolution",
            "grade_id", "enrolment_type"]
    one = pick_one(loaded, FACT_KEY, [("enrolment_id", "asc")], cols)
    return one.select(*FACT_KEY, "term_start_date", F.col("lv_effective_date").alias("learner_version"),
                      F.col("sv_effective_date").alias("school_version"), "resolution", "enrolment_id",
                      "grade_id", "enrolment_type")

"""Schools mart: flatten -> admin-unit SCD2 -> schools SCD2 -> daily fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.operators import scd2
from tessera.operators.dedupe import unique_or_null
from tessera.operators.facts import snapshot_fact
from tessera.session import materialize

# Tracked columns of the schools dimension (hash order) and the
# ordered reason texts of a change.
SCHOOL_TRACKED = ["name", "admin_unit_id", "emis_number", "school_type", "operational_status",
                  "ownership_status", "funding_type", "sex_composition", "boarding_status", "founding_body_type"]
SCHOOL_REASONS = [
    ("name", "School renamed"),
    ("admin_unit_id", "Admin unit re-assignment or boundary update"),
    ("operational_status", "Operational status updated"),
    ("boarding_status", "Boarding status changed"),
    ("sex_composition", "Sex composition changed"),
    ("ownership_status", "Ownership status changed"),
    ("funding_type", "Funding type changed"),
    ("founding_body_type", "Founding body changed"),
]
# Candidate admin levels, most granular first.
ADMIN_LEVELS = ["parish_id", "sub_county_id", "county_id", "district_id", "region_id", "admin_unit_id",
                "local_government_id"]
GENERAL_SUBTYPES = ["pre_primary", "primary", "secondary", "international"]
RESIDENTIAL_SUBTYPES = ["certificate", "diploma"]
ADMIN_KEYS, ADMIN_TRACKED = ["source_id", "admin_unit_type"], ["name", "admin_unit_code", "voting_code", "child_id"]


def flatten_schools(raw: DataFrame, subtypes: dict[str, DataFrame], lookups: dict[str, DataFrame],
                    admin_dim: DataFrame) -> DataFrame:
    """M-S1: decode lookups, merge subtype rows, verify the admin level, drop
    duplicated EMIS numbers (all copies), keep NULL ones."""
    x = raw
    for name, st in subtypes.items():
        x = x.join(st.select(F.col("school_id").alias(f"{name}_sid"),
                             F.col("admits_day_scholars_yn").alias(f"{name}_day"),
                             F.col("admits_boarders_yn").alias(f"{name}_board")),
                   F.col("id") == F.col(f"{name}_sid"), "left")
    lk = {k: F.broadcast(v) for k, v in lookups.items()}  # fixed seed tables
    x = (x.join(lk["setting_school_types"].select(F.col("id").alias("__st"), F.col("name").alias("st_name"),
                                                  F.col("display_name").alias("st_display")),
                F.col("school_type_id") == F.col("__st"), "left")
          .join(lk["setting_operational_statuses"].select(F.col("id").alias("__os"), F.col("name").alias("os_name")),
                F.col("operational_status_id") == F.col("__os"), "left")
          .join(lk["setting_ownership_statuses"].select(F.col("id").alias("__ow"), F.col("name").alias("own_name")),
                F.col("school_ownership_status_id") == F.col("__ow"), "left")
          .join(lk["setting_founding_bodies"].select(F.col("id").alias("__fb"), F.col("name").alias("fb_name")),
                F.col("founding_body_id") == F.col("__fb"), "left"))
    # D-09b: first level whose source id is a current admin unit.
    live = (admin_dim.where(F.col("current_status"))
            .select(F.col("source_id").alias("__sid")).distinct())
    # All levels of a school are candidates of one join; the first that is live wins.
    candidates = x.select(F.col("id").alias("__school"), F.posexplode(F.array(*ADMIN_LEVELS)).alias("__level", "__cand"))
    best = (candidates.join(live, F.col("__cand") == F.col("__sid")).groupBy("__school")
            .agg(F.min(F.struct("__level", "__cand"))["__cand"].alias("__unit")))
    x = x.join(best, F.col("id") == F.col("__school"), "left")
    trip = lambda n: (f"{n}_sid", f"{n}_day", f"{n}_board")
    flat = x.select(
        F.col("id").alias("source_id"),
        "name",
        F.col("__unit").alias("admin_unit_id"),
        "emis_number",
        F.substring(F.coalesce("st_display", "st_name"), 1, 50).alias("school_type"),
        F.substring("os_name", 1, 20).alias("operational_status"),
        F.substring(rules.ownership("own_name", "is_government_owned_yn", null_flag_is_private=False), 1, 60)
         .alias("ownership_status"),
        F.substring(F.col("funding_source_id").cast("string"), 1, 20).alias("funding_type"),
        rules.sex_composition("has_female_students", "has_male_students").alias("sex_composition"),
        rules.boarding_status([trip(n) for n in GENERAL_SUBTYPES], [trip(n) for n in RESIDENTIAL_SUBTYPES])
         .alias("boarding_status"),
        F.substring("fb_name", 1, 60).alias("founding_body_type"))
    return unique_or_null(flat, "emis_number")


def admin_units_scd2(dim: DataFrame | None, raw: DataFrame, as_of) -> DataFrame:
    """M-S4: SCD2 on (source_id, unit type) with surrogate ids."""
    snap = raw.withColumn("id", F.lit(None).cast("long"))
    spark = raw.sparkSession
    if dim is None:
        dim = scd2.empty_dim(spark, snap, ADMIN_KEYS + ADMIN_TRACKED + ["id"]) \
            .withColumnRenamed("is_current", "current_status")
    out = scd2.scd2_merge(dim, snap, ADMIN_KEYS, ADMIN_TRACKED, as_of, extra=["id"],
                          current_col="current_status")
    return scd2.assign_new_ids(out, "id", ADMIN_KEYS + ["effective_date"])


def schools_scd2(dim: DataFrame | None, flat: DataFrame, admin_dim: DataFrame, as_of) -> DataFrame:
    """M-S2: resolve the admin surrogate (left join: unresolved stays NULL,
    decision D25), then merge with the ordered reason rules."""
    # A source id that two unit types share resolves to one unit (D7): a school stays one row.
    cur = admin_dim.where(F.col("current_status")).groupBy(F.col("source_id").alias("__au")).agg(
        F.min("id").alias("__au_id"))
    snap = (flat.join(cur, F.col("admin_unit_id") == F.col("__au"), "left")
                .withColumn("admin_unit_id", F.col("__au_id")).drop("__au", "__au_id"))
    if dim is None:
        dim = scd2.empty_dim(flat.sparkSession, snap, ["source_id"] + SCHOOL_TRACKED)
    return materialize(scd2.scd2_merge(dim, snap, ["source_id"], SCHOOL_TRACKED, as_of,
                                       reason_rules=SCHOOL_REASONS, initial_fields="ALL"))


def school_fact(dim: DataFrame, as_of) -> DataFrame:
    """M-S3: one row per current school for the business date."""
    return snapshot_fact(dim, "source_id", as_of)

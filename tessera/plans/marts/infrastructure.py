"""Infrastructure mart: type dim (SCD1) -> infrastructure_raw -> fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.operators.asof import current_version
from tessera.operators.dedupe import pick_one

FACT_KEY = ["school_id", "building_id", "academic_year", "term"]
TYPE_UPDATE_COLS = ["type_name", "item_category", "is_lab_yn", "is_sanitation_yn", "is_active_yn"]


def type_dim_rows(building_types: DataFrame, categories: DataFrame, infra_types: DataFrame) -> DataFrame:
    """M-F0a: rows for the SCD1 type dimension (upsert on source_id)."""
    b = building_types.where(~F.coalesce(F.col("is_deleted"), F.lit(False)) & ~F.col("is_archived_yn"))
    c = categories.select(F.col("id").alias("__c"), F.col("name").alias("item_category"))
    t = infra_types.select(F.col("id").alias("__t"), "is_lab_yn", "is_sanitation_yn")
    x = b.join(F.broadcast(c), F.col("item_category_id") == F.col("__c"), "left") \
         .join(F.broadcast(t), F.col("id") == F.col("__t"), "left")
    return x.select(F.col("id").alias("source_id"), F.col("name").alias("type_name"), "item_category",
                    F.coalesce("is_lab_yn", F.lit(False)).alias("is_lab_yn"),
                    F.coalesce("is_sanitation_yn", F.lit(False)).alias("is_sanitation_yn"),
                    F.coalesce("is_active_yn", F.lit(True)).alias("is_active_yn"))


def infrastructure_raw(bsu: DataFrame, schools_raw: DataFrame, school_types: DataFrame,
                       building_types: DataFrame, categories: DataFrame, infra_types: DataFrame,
                       years: DataFrame, periods: DataFrame) -> DataFrame:
    """M-F0b: decoded building updates, one row per update id (latest update
    wins on duplicate ids: date_updated desc, then the update id)."""
    s = schools_raw.select(F.col("id").alias("school_id"), F.col("name").alias("school_name"), "school_type_id",
                           F.coalesce("parish_id", "sub_county_id", "county_id", "district_id", "region_id")
                           .alias("admin_unit_source_id"))
    st = school_types.select(F.col("id").alias("school_type_id"), F.col("name").alias("school_type"))
    bt = building_types.select(F.col("id").alias("building_id"), F.col("name").alias("building_name"),
                               "item_category_id")
    cat = categories.select(F.col("id").alias("item_category_id"), F.col("name").alias("item_category"))
    it = infra_types.select(F.col("id").alias("building_id"), F.col("name").alias("infrastructure_type_name"),
                            "is_lab_yn", "is_sanitation_yn")
    # Picked before the codes are resolved: their texts don't cross the network.
    coded = bsu.join(s, "school_id")
    first = ["school_id", "school_name", "school_type_id", "admin_unit_source_id"]
    coded = pick_one(coded, ["id"], [("date_updated", "desc", "last"), ("school_id", "desc")],
                     first + [c for c in coded.columns if c not in ("id", *first)])
    x = (coded.join(F.broadcast(st), "school_type_id", "left")
            .join(F.broadcast(bt), "building_id", "left")
            .join(F.broadcast(cat), "item_category_id", "left")
            .join(F.broadcast(it), "building_id", "left")
            .join(F.broadcast(years.select(F.col("id").alias("academic_year_id"), F.col("name").alias("__ay"))),
                  "academic_year_id", "left")
            .join(F.broadcast(periods.select(F.col("id").alias("teaching_period_id"), F.col("name").alias("__tp"))),
                  "teaching_period_id", "left"))
    return x.select(
        F.col("id").alias("building_status_id"), "school_id", "school_name", "school_type", "admin_unit_source_id",
        "building_id", "building_name", "item_category", "infrastructure_type_name",
        F.coalesce("is_lab_yn", F.lit(False)).alias("is_lab_yn"),
        F.coalesce("is_sanitation_yn", F.lit(False)).alias("is_sanitation_yn"),
        rules.academic_year("__ay", "date_created").alias("academic_year"),
        rules.term_label("__tp").alias("term"),
        "total_number", rules.area_clean("area").alias("area"),
        rules.code_map("completion_status", rules.COMPLETION_STATUS).alias("completion_status"),
        rules.code_map("usage_mode", rules.USAGE_MODE).alias("usage_mode"),
        rules.code_map("condition", rules.CONDITION).alias("structure_condition"),
        rules.code_map("gender_usage", rules.GENDER_USAGE).alias("gender_usage"),
        rules.code_map("user_category", rules.USER_CATEGORY).alias("user_category"),
        "date_created", "date_updated")


def infrastructure_fact(raw: DataFrame, school_dim: DataFrame, type_dim: DataFrame, terms: DataFrame) -> DataFrame:
    """M-F1: current school version, type, term date (calendar start, else
    Feb 1), one row per (school, building, year, term): the latest update."""
    sch = current_version(school_dim, "source_id", ["effective_date"])
    sch = sch.select(F.col("source_id").alias("__s"), F.col("effective_date").alias("school_version"))
    typ = type_dim.select(F.col("source_id").alias("building_id"), F.col("type_name").alias("infra_type_name"))
    r = raw.where(F.col("school_id").isNotNull() & F.col("building_id").isNotNull()
                  & F.col("academic_year").isNotNull())
    x = (r.join(sch, F.col("school_id").cast("long") == F.col("__s").cast("long"))
          .join(F.broadcast(typ), "building_id")
          .join(F.broadcast(terms), ["academic_year", "term"], "left"))
    x = x.withColumn("term_date", F.coalesce("term_start_date", F.make_date("academic_year", F.lit(2), F.lit(1))))
    keep = ["school_version", "infra_type_name", "term_date", "total_number", "area", "completion_status",
            "usage_mode", "structure_condition", "gender_usage", "user_category", "building_status_id"]
    return pick_one(x, FACT_KEY, [("date_updated", "desc", "last"), ("building_status_id", "desc")], keep)

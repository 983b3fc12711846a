"""Education source tables derived from the test tables (Spark + SQL).

schools         <- supplier (one school per supplier)
school subtypes <- supplier, by nation
persons/learners<- customer
enrolments      <- orders (school = supplier on the order's first line)
Lookups are the small code tables the warehouse seeds inline (SRC-08).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.plans import views as V
from tessera.session import materialize

# ---------------------------------------------------------------------------
# Inline lookup rows (id, name[, display_name]).
# ---------------------------------------------------------------------------
SCHOOL_TYPES = [(1, "PRE-PRIMARY", "Pre-Primary"), (2, "PRIMARY", None), (3, "SECONDARY", "Secondary School"),
                (4, "INTERNATIONAL", None)]
OPERATIONAL_STATUSES = [(1, "OPERATIONAL"), (2, "CLOSED"), (3, "SUSPENDED TEMPORARILY BY AUTHORITY")]
OWNERSHIP_STATUSES = [(1, "GOVERNMENT"), (2, "PRIVATE")]
FOUNDING_BODIES = [(1, "CHURCH OF UGANDA"), (2, "CATHOLIC"), (3, "ISLAMIC"), (4, "GOVERNMENT"),
                   (5, "COMMUNITY"), (6, "PRIVATE ENTITY")]
SUBTYPES = ["pre_primary", "primary", "secondary", "international", "certificate", "diploma"]


def lookups(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "setting_school_types": spark.createDataFrame(SCHOOL_TYPES, "id long, name string, display_name string"),
        "setting_operational_statuses": spark.createDataFrame(OPERATIONAL_STATUSES, "id long, name string"),
        "setting_ownership_statuses": spark.createDataFrame(OWNERSHIP_STATUSES, "id long, name string"),
        "setting_founding_bodies": spark.createDataFrame(FOUNDING_BODIES, "id long, name string"),
    }


def _values(rows, cols):
    def lit(v):
        return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) v({', '.join(cols)})"


LOOKUPS_SQL = f"""setting_school_types AS (SELECT CAST(id AS BIGINT) AS id, name, display_name FROM {_values(SCHOOL_TYPES, ['id', 'name', 'display_name'])}),
setting_operational_statuses AS (SELECT CAST(id AS BIGINT) AS id, name FROM {_values(OPERATIONAL_STATUSES, ['id', 'name'])}),
setting_ownership_statuses AS (SELECT CAST(id AS BIGINT) AS id, name FROM {_values(OWNERSHIP_STATUSES, ['id', 'name'])}),
setting_founding_bodies AS (SELECT CAST(id AS BIGINT) AS id, name FROM {_values(FOUNDING_BODIES, ['id', 'name'])})"""


def schools_raw(supplier: DataFrame, nation: DataFrame, day: int = 1) -> DataFrame:
    """stg.schools_raw-shaped frame. Codes grow with the key; every 20th pair
    of schools shares one (a planted duplicate, the same share at any size).
    Day 2 renames every 11th school and changes the operational status of
    every 7th."""
    s = supplier.join(nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey"), "s_nationkey")
    k = F.col("s_suppkey")
    C = V.UNIT_CODE
    name = F.col("s_name")
    op = (k % 3 + 1)
    if day == 2:
        name = F.when(k % 11 == 0, F.concat(name, F.lit(" II"))).otherwise(name)
        op = F.when(k % 7 == 0, (k + 1) % 3 + 1).otherwise(op)
    return s.select(
        k.alias("id"), name.alias("name"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("E"), F.when(k % 40 < 2, k - k % 2).otherwise(k).cast("string"))).alias("emis_number"),
        F.when(F.col("s_acctbal") < 0, k * 10).otherwise(k * 10 + C["Parish"]).alias("parish_id"),
        (F.col("s_nationkey").cast("long") * 10 + C["Sub County"]).alias("sub_county_id"),
        (F.col("s_nationkey").cast("long") * 10 + C["County"]).alias("county_id"),
        (F.col("n_regionkey").cast("long") * 10 + C["District"]).alias("district_id"),
        F.lit(None).cast("long").alias("region_id"),
        F.lit(None).cast("long").alias("admin_unit_id"),
        (F.col("s_nationkey").cast("long") * 10 + C["Town Council"]).alias("local_government_id"),
        (F.col("s_nationkey") % 4 + 1).cast("long").alias("school_type_id"),
        op.cast("long").alias("operational_status_id"),
        F.when(k % 5 == 0, F.lit(None).cast("long")).otherwise(k % 2 + 1).alias("school_ownership_status_id"),
        F.when(k % 7 == 0, F.lit(None).cast("boolean")).otherwise(F.col("s_acctbal") > 3000)
         .alias("is_government_owned_yn"),
        (k % 4).alias("funding_source_id"),
        (F.col("s_acctbal") > 0).alias("has_female_students"),
        F.when(k % 4 == 0, F.lit(None).cast("boolean")).otherwise(k % 3 != 0).alias("has_male_students"),
        (k % 6 + 1).alias("founding_body_id"))


def schools_raw_sql(day: int = 1, name: str = "schools_raw") -> str:
    C = V.UNIT_CODE
    nm = "s.s_name" if day == 1 else "CASE WHEN s.s_suppkey % 11 = 0 THEN s.s_name || ' II' ELSE s.s_name END"
    op = "s.s_suppkey % 3 + 1" if day == 1 else \
        "CASE WHEN s.s_suppkey % 7 = 0 THEN (s.s_suppkey + 1) % 3 + 1 ELSE s.s_suppkey % 3 + 1 END"
    return f"""{name} AS (
  SELECT s.s_suppkey AS id, {nm} AS name,
         CASE WHEN s.s_suppkey % 17 = 0 THEN NULL ELSE 'E' || CAST(CASE WHEN s.s_suppkey % 40 < 2 THEN s.s_suppkey - s.s_suppkey % 2 ELSE s.s_suppkey END AS VARCHAR) END AS emis_number,
         CASE WHEN s.s_acctbal < 0 THEN s.s_suppkey * 10 ELSE s.s_suppkey * 10 + {C['Parish']} END AS parish_id,
         CAST(s.s_nationkey AS BIGINT) * 10 + {C['Sub County']} AS sub_county_id,
         CAST(s.s_nationkey AS BIGINT) * 10 + {C['County']} AS county_id,
         CAST(n.n_regionkey AS BIGINT) * 10 + {C['District']} AS district_id,
         CAST(NULL AS BIGINT) AS region_id, CAST(NULL AS BIGINT) AS admin_unit_id,
         CAST(s.s_nationkey AS BIGINT) * 10 + {C['Town Council']} AS local_government_id,
         CAST(s.s_nationkey % 4 + 1 AS BIGINT) AS school_type_id,
         CAST({op} AS BIGINT) AS operational_status_id,
         CASE WHEN s.s_suppkey % 5 = 0 THEN NULL ELSE s.s_suppkey % 2 + 1 END AS school_ownership_status_id,
         CASE WHEN s.s_suppkey % 7 = 0 THEN NULL ELSE s.s_acctbal > 3000 END AS is_government_owned_yn,
         s.s_suppkey % 4 AS funding_source_id,
         s.s_acctbal > 0 AS has_female_students,
         CASE WHEN s.s_suppkey % 4 = 0 THEN NULL ELSE s.s_suppkey % 3 <> 0 END AS has_male_students,
         s.s_suppkey % 6 + 1 AS founding_body_id
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey)"""


def subtype(supplier: DataFrame, i: int) -> DataFrame:
    """Subtype table i (pre-primary, primary, ..., diploma): school_id + flags."""
    k = F.col("s_suppkey")
    return supplier.where(F.col("s_nationkey") % 6 == i).select(
        k.alias("school_id"),
        F.when(k % 7 == 0, F.lit(None).cast("boolean")).otherwise(k % 2 == 0).alias("admits_day_scholars_yn"),
        F.when(k % 11 == 0, F.lit(None).cast("boolean")).otherwise(k % 3 == 0).alias("admits_boarders_yn"))


def subtype_sql(i: int) -> str:
    return (f"st_{SUBTYPES[i]} AS (SELECT s_suppkey AS school_id, "
            f"CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_suppkey % 2 = 0 END AS admits_day_scholars_yn, "
            f"CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE s_suppkey % 3 = 0 END AS admits_boarders_yn "
            f"FROM supplier WHERE s_nationkey % 6 = {i})")


SUBTYPES_SQL = ",\n".join(subtype_sql(i) for i in range(6))


def admin_units_raw(region, nation, supplier, day: int = 1) -> DataFrame:
    """admin_units_raw snapshot: the live units with their codes; every 7th has
    no voting code. Day 2 renames every 4th nation's Sub County and gives every
    5th County another voting code."""
    u = V.admin_units(region, nation, supplier).where("current_status")
    name = F.col("name")
    if day == 2:
        name = F.when((F.col("admin_unit_type") == "Sub County") & F.expr("(source_id - 4) div 10 % 4 = 0"),
                      F.concat(name, F.lit(" NEW"))).otherwise(name)
    voting = F.when(F.col("source_id") % 7 != 0, F.concat(F.lit("V"), F.col("source_id").cast("string")))
    if day == 2:
        voting = F.when((F.col("admin_unit_type") == "County") & F.expr("source_id div 10 % 5 = 0"), F.concat(F.lit("W"), F.col("source_id").cast("string"))) \
            .otherwise(voting)
    code = F.concat(F.upper(F.substring("admin_unit_type", 1, 2)), F.lit("/"), F.col("source_id").cast("string"))
    return u.select("source_id", "admin_unit_type", name.alias("name"), code.alias("admin_unit_code"), voting.alias("voting_code"), "child_id")


def admin_units_raw_sql(day: int = 1, name: str = "au_raw") -> str:
    nm = "name" if day == 1 else \
        "CASE WHEN admin_unit_type = 'Sub County' AND ((source_id - 4) // 10) % 4 = 0 THEN name || ' NEW' ELSE name END"
    voting = "CASE WHEN source_id % 7 <> 0 THEN 'V' || CAST(source_id AS VARCHAR) END"
    if day == 2:
        voting = f"CASE WHEN admin_unit_type = 'County' AND source_id // 10 % 5 = 0 THEN 'W' || CAST(source_id AS VARCHAR) ELSE {voting} END"
    return f"""{name} AS (SELECT source_id, admin_unit_type, {nm} AS name, upper(left(admin_unit_type, 2)) || '/' || CAST(source_id AS VARCHAR) AS admin_unit_code,
  {voting} AS voting_code, child_id FROM admin_units WHERE current_status)"""


# ---------------------------------------------------------------------------
# Learners and enrolments (customer, orders, events).
# Seed lookups of the enrolment mart.
# ---------------------------------------------------------------------------
DISABILITY_TYPES = [(1, "Visual impairment"), (2, "Hearing loss"), (3, "Walking difficulty"),
                    (4, "Difficulty remembering"), (5, "Self care difficulty"), (6, "Communication difficulty")]
IDENTITY_TYPES = [(1, "National ID"), (2, "Passport"), (3, "Student Pass"), (4, "Work permit"), (5, "Refugee card")]
ENROLMENT_TYPES = [(1, "New"), (2, "Continuing"), (3, "Baseline")]
IDENTITY_EVENT = {"view": 1, "signup": 2, "purchase": 3, "click": 4, "error": 5}


def enrolment_lookups(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "setting_disability_types": spark.createDataFrame(DISABILITY_TYPES, "id long, name string"),
        "setting_identity_document_types": spark.createDataFrame(IDENTITY_TYPES, "id long, name string"),
        "setting_enrolment_types": spark.createDataFrame(ENROLMENT_TYPES, "id long, name string"),
    }


ENROLMENT_LOOKUPS_SQL = f"""setting_disability_types AS (SELECT CAST(id AS BIGINT) AS id, name FROM {_values(DISABILITY_TYPES, ['id', 'name'])}),
setting_identity_document_types AS (SELECT CAST(id AS BIGINT) AS id, name FROM {_values(IDENTITY_TYPES, ['id', 'name'])}),
setting_enrolment_types AS (SELECT CAST(id AS BIGINT) AS id, name FROM {_values(ENROLMENT_TYPES, ['id', 'name'])})"""


def _country(day: int):
    home = F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey").cast("long"))
    if day == 2:
        home = F.when(F.col("c_custkey") % 10 == 0, ((F.col("c_nationkey") + 1) % 25).cast("long")).otherwise(home)
    return home


def persons(customer: DataFrame, day: int = 1) -> DataFrame:
    """Day 2 changes the surname of every 9th person (not a tracked column of
    the learner dimension) and moves every 10th to another country (tracked)."""
    k = F.col("c_custkey")
    surname = F.split_part("c_name", F.lit("#"), F.lit(1))
    if day == 2:
        surname = F.when(k % 9 == 0, F.concat(surname, F.lit("-M"))).otherwise(surname)
    return customer.select(
        k.alias("id"), surname.alias("surname"),
        F.concat(F.lit("L"), (k % 97).cast("string")).alias("first_name"),
        F.when(k % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.split_part("c_name", F.lit("#"), F.lit(2))).alias("other_names"),
        (F.when(k % 23 == 0, F.lit(None).cast("string")).when(k % 10 == 1, F.lit("Male"))
          .when(k % 10 == 2, F.lit("female")).when(k % 2 == 0, F.lit("M")).otherwise(F.lit("F"))).alias("gender"),
        F.when(k % 29 == 0, F.lit(None).cast("date"))
         .otherwise(F.make_date((1980 + k % 20).cast("int"), (1 + k % 12).cast("int"), (1 + k % 28).cast("int")))
         .alias("birth_date"),
        _country(day).alias("country_id"))


def persons_sql(day: int = 1, name: str = "persons") -> str:
    sn = "split_part(c_name, '#', 1)" if day == 1 else \
        "CASE WHEN c_custkey % 9 = 0 THEN split_part(c_name, '#', 1) || '-M' ELSE split_part(c_name, '#', 1) END"
    country = "CASE WHEN c_nationkey % 2 = 0 THEN CAST(c_nationkey AS BIGINT) END"
    if day == 2:
        country = f"CASE WHEN c_custkey % 10 = 0 THEN CAST((c_nationkey + 1) % 25 AS BIGINT) ELSE {country} END"
    return f"""{name} AS (SELECT c_custkey AS id, {sn} AS surname, 'L' || CAST(c_custkey % 97 AS VARCHAR) AS first_name,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS other_names,
  CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 'Male' WHEN c_custkey % 10 = 2 THEN 'female'
       WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE make_date(CAST(1980 + c_custkey % 20 AS INTEGER),
       CAST(1 + c_custkey % 12 AS INTEGER), CAST(1 + c_custkey % 28 AS INTEGER)) END AS birth_date,
  {country} AS country_id
FROM customer)"""


def learners(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("person_id"), F.concat(F.lit("LIN"), k.cast("string")).alias("lin"),
        (F.col("c_acctbal") < 0).alias("is_mother_dead"),
        F.when(k % 7 == 0, F.lit(None).cast("boolean")).otherwise(k % 5 == 0).alias("is_father_dead"),
        F.when(F.col("c_acctbal") < -900, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
         .alias("deleted_at"))


LEARNERS_SRC_SQL = """learners_src AS (SELECT c_custkey AS person_id, 'LIN' || CAST(c_custkey AS VARCHAR) AS lin,
  c_acctbal < 0 AS is_mother_dead, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 5 = 0 END AS is_father_dead,
  CASE WHEN c_acctbal < -900 THEN TIMESTAMP '2024-01-01 00:00:00' END AS deleted_at FROM customer)"""


def enrolments(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """learner_enrolments: school = supplier on the order's first line (the
    smallest line number, then supplier, that the order has)."""
    school = V.first_supplier(lineitem, "id", "school_id")
    k, m = F.col("o_orderkey"), F.month("o_orderdate")
    e = orders.select(
        k.alias("id"), F.col("o_custkey").alias("learner_id"),
        F.year("o_orderdate").cast("long").alias("academic_year_id"),
        F.when(m <= 4, 1).when(m <= 8, 2).otherwise(3).cast("long").alias("teaching_period_id"),
        F.substring("o_orderpriority", 1, 1).cast("long").alias("education_grade_id"),
        F.when(k % 13 == 0, F.lit(None).cast("long")).otherwise(k % 3 + 1).alias("enrolment_type_id"),
        (F.col("o_orderstatus") != "P").alias("is_enrolment_active_yn"),
        F.col("o_orderdate").alias("date_created"))
    return e.join(school, "id", "left")


ENROLMENTS_SQL = """learner_enrolments AS (
  SELECT o.o_orderkey AS id, o.o_custkey AS learner_id, CAST(year(o.o_orderdate) AS BIGINT) AS academic_year_id,
         CAST(CASE WHEN month(o.o_orderdate) <= 4 THEN 1 WHEN month(o.o_orderdate) <= 8 THEN 2 ELSE 3 END AS BIGINT) AS teaching_period_id,
         CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) AS education_grade_id,
         CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_orderkey % 3 + 1 END AS enrolment_type_id,
         o.o_orderstatus <> 'P' AS is_enrolment_active_yn, o.o_orderdate AS date_created, f.school_id
  FROM orders o LEFT JOIN (SELECT l_orderkey, first(l_suppkey ORDER BY l_linenumber, l_suppkey) AS school_id
                           FROM lineitem GROUP BY l_orderkey) f ON f.l_orderkey = o.o_orderkey)"""


def _event_code(mapping: dict):
    out = None
    for ev, code in mapping.items():
        c = F.col("event_type") == ev
        out = F.when(c, F.lit(code)) if out is None else out.when(c, F.lit(code))
    return out.cast("long")


def learner_disabilities(events: DataFrame) -> DataFrame:
    """One record per event; the types take turns."""
    return events.select(F.col("user_id").alias("learner_id"),
                         (F.col("event_id") % len(DISABILITY_TYPES) + 1).cast("long").alias("disability_type_id"))


def identity_documents(events: DataFrame) -> DataFrame:
    return events.select(F.col("user_id").alias("person_id"),
                         _event_code(IDENTITY_EVENT).alias("identity_type_id"),
                         F.concat(F.lit("D"), F.col("event_id").cast("string")).alias("document_id")) \
                 .where(F.col("identity_type_id").isNotNull())


def _case_sql(mapping: dict) -> str:
    return "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items()) + " END"


EVENTS_SRC_SQL = f"""learner_disabilities AS (SELECT user_id AS learner_id, CAST(event_id % {len(DISABILITY_TYPES)} + 1 AS BIGINT) AS disability_type_id
  FROM events),
identity_documents AS (SELECT person_id, identity_type_id, document_id FROM (
    SELECT user_id AS person_id, CAST({_case_sql(IDENTITY_EVENT)} AS BIGINT) AS identity_type_id,
           'D' || CAST(event_id AS VARCHAR) AS document_id FROM events) x
  WHERE identity_type_id IS NOT NULL)"""


# ---------------------------------------------------------------------------
# Infrastructure: building status updates from lineitem; type seeds.
# Building types (id, name, item category id, active, archived,
# deleted), item categories, infrastructure types (id, name, lab, sanitation).
# ---------------------------------------------------------------------------
BUILDING_TYPES = [(1, "Classroom", 1, True, False, False), (2, "Laboratory", 1, True, False, False),
                  (3, "Library", 1, True, False, False), (4, "Latrine", 2, True, False, False),
                  (5, "Urinal", 2, None, False, False), (6, "Dormitory", 3, True, False, False),
                  (7, "Staff house", 3, True, False, False), (8, "Kitchen", 4, False, False, False),
                  (9, "Water tank", 4, True, False, False), (10, "Workshop", 1, True, False, False),
                  (11, "Old store", 4, True, True, False), (12, "Demolished block", 4, True, False, True)]
ITEM_CATEGORIES = [(1, "TEACHING SPACE"), (2, "SANITATION"), (3, "ACCOMMODATION"), (4, "OTHER")]
INFRA_TYPES = [(1, "Classroom", False, False), (2, "Science laboratory", True, False), (3, "Library", False, False),
               (4, "Pit latrine", False, True), (5, "Urinal", False, True), (6, "Dormitory", False, False),
               (9, "Water tank", False, None), (10, "Workshop", None, False)]


def infra_lookups(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "setting_school_building_types": spark.createDataFrame(
            [(i, n, c, a, ar, d) for i, n, c, a, ar, d in BUILDING_TYPES],
            "id long, name string, item_category_id long, is_active_yn boolean, is_archived_yn boolean, "
            "is_deleted boolean"),
        "setting_school_item_categories": spark.createDataFrame(ITEM_CATEGORIES, "id long, name string"),
        "setting_school_infrastructure_types": spark.createDataFrame(
            INFRA_TYPES, "id long, name string, is_lab_yn boolean, is_sanitation_yn boolean"),
    }


INFRA_LOOKUPS_SQL = f"""setting_school_building_types AS (SELECT CAST(id AS BIGINT) AS id, name, CAST(item_category_id AS BIGINT) AS item_category_id,
    is_active_yn, is_archived_yn, is_deleted FROM {_values(BUILDING_TYPES, ['id', 'name', 'item_category_id', 'is_active_yn', 'is_archived_yn', 'is_deleted'])}),
setting_school_item_categories AS (SELECT CAST(id AS BIGINT) AS id, name FROM {_values(ITEM_CATEGORIES, ['id', 'name'])}),
setting_school_infrastructure_types AS (SELECT CAST(id AS BIGINT) AS id, name, is_lab_yn, is_sanitation_yn
    FROM {_values(INFRA_TYPES, ['id', 'name', 'is_lab_yn', 'is_sanitation_yn'])})"""


def building_updates(lineitem: DataFrame) -> DataFrame:
    """school_building_status_updates from lineitem (codes by key digits,
    including out-of-range codes and areas)."""
    li = lineitem
    m = F.month("l_shipdate")
    area = (F.when(F.col("l_discount") == 0.1, F.lit(-1.0))
             .when(F.col("l_tax") == 0.08, F.lit(1e14))
             .otherwise(F.col("l_extendedprice") / 100))
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_suppkey").alias("school_id"),
        (F.col("l_partkey") % 12 + 1).alias("building_id"),
        F.year("l_shipdate").cast("long").alias("academic_year_id"),
        F.when(m <= 4, 1).when(m <= 8, 2).otherwise(3).cast("long").alias("teaching_period_id"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("int"))
         .otherwise(F.col("l_quantity").cast("int")).alias("total_number"),
        area.alias("area"),
        (F.col("l_partkey") % 5).cast("short").alias("completion_status"),
        (F.col("l_suppkey") % 4).cast("short").alias("usage_mode"),
        (F.col("l_linenumber") % 5).cast("short").alias("condition"),
        (F.col("l_orderkey") % 5).cast("short").alias("gender_usage"),
        (F.col("l_partkey") % 4).cast("short").alias("user_category"),
        F.col("l_shipdate").alias("date_created"),
        (F.col("l_shipdate") + F.make_dt_interval(F.col("l_linenumber").cast("int"))).alias("date_updated"))


BUILDING_UPDATES_SQL = """bsu AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS school_id, l_partkey % 12 + 1 AS building_id,
         CAST(year(l_shipdate) AS BIGINT) AS academic_year_id,
         CAST(CASE WHEN month(l_shipdate) <= 4 THEN 1 WHEN month(l_shipdate) <= 8 THEN 2 ELSE 3 END AS BIGINT) AS teaching_period_id,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS total_number,
         CASE WHEN l_discount = 0.1 THEN -1.0 WHEN l_tax = 0.08 THEN 1e14 ELSE l_extendedprice / 100 END AS area,
         CAST(l_partkey % 5 AS SMALLINT) AS completion_status, CAST(l_suppkey % 4 AS SMALLINT) AS usage_mode,
         CAST(l_linenumber % 5 AS SMALLINT) AS condition, CAST(l_orderkey % 5 AS SMALLINT) AS gender_usage,
         CAST(l_partkey % 4 AS SMALLINT) AS user_category, l_shipdate AS date_created,
         l_shipdate + to_days(CAST(l_linenumber AS INTEGER)) AS date_updated
  FROM lineitem)"""


# ---------------------------------------------------------------------------
# Teachers: part -> teacher persons; lineitem -> postings and subjects.
# Teacher-type and qualification seed rows.
# ---------------------------------------------------------------------------
TEACHER_OFFSET = 1_000_000
TEACHER_TYPES = [(1, "LICENSED"), (2, "PROBATIONARY"), (3, "VOLUNTEER")]
QUALIFICATIONS = [(1, "GRADE III", "CERTIFICATE"), (2, "GRADE V", "DIPLOMA"), (3, "DEGREE", "GRADUATE"), (4, "MASTERS", "POSTGRADUATE"),
                  (5, "PHD", "POSTGRADUATE")]
DESIGNATIONS = [(1, "HEAD TEACHER"), (2, "DEPUTY HEAD TEACHER"), (3, "CLASS TEACHER")]
EDUCATION_LEVELS = [(1, "O LEVEL"), (2, "A LEVEL"), (3, "TERTIARY"), (4, "UNIVERSITY")]
EMPLOYMENT_STATUSES = [(1, "PERMANENT"), (2, "CONTRACT"), (3, "TEMPORARY")]


def employment_lookups(spark: SparkSession) -> dict[str, DataFrame]:
    return {"setting_education_levels": spark.createDataFrame(EDUCATION_LEVELS, "id long, name string"),
            "setting_employment_statuses": spark.createDataFrame(EMPLOYMENT_STATUSES, "id long, name string")}


EMPLOYMENT_LOOKUPS_SQL = f"""setting_education_levels AS (SELECT CAST(id AS BIGINT) AS id, name FROM {_values(EDUCATION_LEVELS, ['id', 'name'])}),
setting_employment_statuses AS (SELECT CAST(id AS BIGINT) AS id, name FROM {_values(EMPLOYMENT_STATUSES, ['id', 'name'])})"""


def teacher_lookups(spark: SparkSession) -> dict[str, DataFrame]:
    return {"setting_teacher_types": spark.createDataFrame(TEACHER_TYPES, "id long, name string"),
            "setting_teacher_professional_qualifications": spark.createDataFrame(
                QUALIFICATIONS, "id long, name string, qualification_category string"),
            "setting_teaching_staff_designations": spark.createDataFrame(DESIGNATIONS, "id long, name string")}


TEACHER_LOOKUPS_SQL = f"""setting_teacher_types AS (SELECT CAST(id AS BIGINT) AS id, name FROM {_values(TEACHER_TYPES, ['id', 'name'])}),
setting_teaching_staff_designations AS (SELECT CAST(id AS BIGINT) AS id, name FROM {_values(DESIGNATIONS, ['id', 'name'])}),
setting_teacher_professional_qualifications AS (SELECT CAST(id AS BIGINT) AS id, name, qualification_category
    FROM {_values(QUALIFICATIONS, ['id', 'name', 'qualification_category'])})"""


def teachers_src(part: DataFrame, day: int = 1) -> DataFrame:
    """persons + teachers in one frame (person_id = part key + offset). Day 2
    renumbers every 7th teacher (not tracked), changes the type of every 9th
    and the designation of every 10th (tracked)."""
    k = F.col("p_partkey")
    kind = F.col("p_size") % 3 + 1
    if day == 2:
        kind = F.when(k % 9 == 0, (F.col("p_size") + 1) % 3 + 1).otherwise(kind)
    ipps = F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("IPPS"), k.cast("string")))
    if day == 2:
        ipps = F.when(k % 7 == 0, F.concat(F.lit("IPPS-N"), k.cast("string"))).otherwise(ipps)
    return part.select(
        (k + TEACHER_OFFSET).alias("person_id"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("surname"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("first_name"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("other_names"),
        F.when(k % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.make_date((1960 + k % 35).cast("int"), (1 + k % 12).cast("int"), (1 + k % 28).cast("int")).alias("birth_date"),
        kind.cast("long").alias("teacher_type_id"),
        (F.col("p_size") % 5 + 1).cast("long").alias("qualification_id"),
        ipps.alias("ipps_number"),
        F.when(k % 4 == 0, F.lit(None).cast("boolean")).otherwise(F.col("p_retailprice") > 1500)
         .alias("is_on_government_payroll"),
        F.when(k % 11 != 0, (F.col("p_size") % 25).cast("long")).alias("country_id"),
        (F.when(k % 10 == 0, F.lit(day)).otherwise(F.col("p_size") % 3 + 1)).cast("long").alias("designation_id"))


def teachers_src_sql(day: int = 1, name: str = "teachers_src") -> str:
    kind = "p_size % 3 + 1" if day == 1 else "CASE WHEN p_partkey % 9 = 0 THEN (p_size + 1) % 3 + 1 ELSE p_size % 3 + 1 END"
    ipps = "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE 'IPPS' || CAST(p_partkey AS VARCHAR) END"
    if day == 2:
        ipps = f"CASE WHEN p_partkey % 7 = 0 THEN 'IPPS-N' || CAST(p_partkey AS VARCHAR) ELSE {ipps} END"
    return f"""{name} AS (SELECT p_partkey + {TEACHER_OFFSET} AS person_id, split_part(p_name, ' ', 2) AS surname,
  split_part(p_name, ' ', 1) AS first_name, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS other_names,
  CASE WHEN p_partkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  make_date(CAST(1960 + p_partkey % 35 AS INTEGER), CAST(1 + p_partkey % 12 AS INTEGER), CAST(1 + p_partkey % 28 AS INTEGER)) AS birth_date,
  CAST({kind} AS BIGINT) AS teacher_type_id, CAST(p_size % 5 + 1 AS BIGINT) AS qualification_id,
  {ipps} AS ipps_number,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_retailprice > 1500 END AS is_on_government_payroll,
  CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_size % 25 AS BIGINT) END AS country_id,
  CAST(CASE WHEN p_partkey % 10 = 0 THEN {day} ELSE p_size % 3 + 1 END AS BIGINT) AS designation_id
FROM part)"""


RECORD_STEP = 2 ** 31   # an employee record's id: part key times this, plus supplier key


def _employments(lineitem: DataFrame, offset: int) -> DataFrame:
    """Employee records: one per (person, school) that ships the part, started
    on the first shipment and last updated on the latest."""
    part, school = F.col("l_partkey"), F.col("l_suppkey")
    record = part.cast("long") * RECORD_STEP + school
    one = lineitem.groupBy(part, school).agg(
        F.count(F.lit(1)).alias("weekly_teaching_periods"),
        F.to_date(F.min("l_shipdate")).alias("date_started"), F.to_date(F.max("l_shipdate")).alias("date_updated"))
    return one.select(
        record.alias("id"), (part + offset).alias("person_id"), school.alias("school_id"), "date_started", F.col("date_started").alias("date_created"),
        "date_updated", "weekly_teaching_periods", F.concat(F.lit("HR"), record.cast("string")).alias("hrin"),
        F.when(school % 2 == 0, F.concat(F.lit("IPPS-E"), part.cast("string"))).alias("ipps_number"),
        F.when(school % 3 != 0, (part + school) % 2 == 0).alias("is_on_government_payroll"),
        ((part + school) % 4 + 1).cast("long").alias("highest_education_level_id"),
        (school % 4).cast("long").alias("employment_status_id"))


def _employments_sql(name: str, offset: int) -> str:
    return f"""{name} AS (SELECT l_partkey * {RECORD_STEP} + l_suppkey AS id, l_partkey + {offset} AS person_id,
  l_suppkey AS school_id, CAST(min(l_shipdate) AS DATE) AS date_started, CAST(min(l_shipdate) AS DATE) AS date_created,
  CAST(max(l_shipdate) AS DATE) AS date_updated, count(*) AS weekly_teaching_periods,
  'HR' || CAST(l_partkey * {RECORD_STEP} + l_suppkey AS VARCHAR) AS hrin,
  CASE WHEN l_suppkey % 2 = 0 THEN 'IPPS-E' || CAST(l_partkey AS VARCHAR) END AS ipps_number,
  CASE WHEN l_suppkey % 3 <> 0 THEN (l_partkey + l_suppkey) % 2 = 0 END AS is_on_government_payroll,
  CAST((l_partkey + l_suppkey) % 4 + 1 AS BIGINT) AS highest_education_level_id, CAST(l_suppkey % 4 AS BIGINT) AS employment_status_id
FROM lineitem GROUP BY l_partkey, l_suppkey)"""


def school_employees(lineitem: DataFrame) -> DataFrame:
    """The employee records of teachers."""
    return _employments(lineitem, TEACHER_OFFSET)


SCHOOL_EMPLOYEES_SQL = _employments_sql("school_employees", TEACHER_OFFSET)


def teacher_documents(lineitem: DataFrame) -> DataFrame:
    """Identity documents of teachers; some are of types without an entry."""
    return lineitem.select((F.col("l_partkey") + TEACHER_OFFSET).alias("person_id"), F.col("l_linenumber").cast("long").alias("identity_type_id"),
                           F.concat(F.lit("T"), F.col("l_orderkey").cast("string")).alias("document_id"))


TEACHER_DOCUMENTS_SQL = f"""teacher_documents AS (SELECT l_partkey + {TEACHER_OFFSET} AS person_id, CAST(l_linenumber AS BIGINT) AS identity_type_id,
  'T' || CAST(l_orderkey AS VARCHAR) AS document_id FROM lineitem)"""


def teacher_subjects(lineitem: DataFrame) -> DataFrame:
    return lineitem.select((F.col("l_partkey") + TEACHER_OFFSET).alias("person_id"),
                           F.col("l_linenumber").cast("long").alias("subject_id")).distinct() \
                   .withColumn("is_science_subject", F.col("subject_id") <= 3)


TEACHER_SUBJECTS_SQL = f"""teacher_subjects AS (SELECT DISTINCT l_partkey + {TEACHER_OFFSET} AS person_id,
  CAST(l_linenumber AS BIGINT) AS subject_id, l_linenumber <= 3 AS is_science_subject FROM lineitem)"""


def teacher_transfers(lineitem: DataFrame) -> DataFrame:
    """Transfers: each line moves a teacher from its own supplier to the one on
    the order's first line. Every 50th order has no posting date, line 5 no
    reporting date, line 7 no incoming local government."""
    part, out, line, day = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), F.col("__day")
    order = F.col("l_orderkey")
    lines = lineitem.select(order, part, out, line, F.to_date("l_shipdate").alias("__day"))
    # The lines of an order cross the network once, and its first line (as in ``first_supplier``) is found among them. They are
    # stored, and their shuffle goes, before the wider rows made of them are shuffled.
    first = F.first(out).over(Window.partitionBy(order).orderBy(line, out))
    x = lines.where(order.isNotNull()).withColumn("incoming_school_id", first) \
             .unionByName(lines.where(order.isNull()).withColumn("incoming_school_id", F.lit(None).cast(lines.schema["l_suppkey"].dataType)))
    x = materialize(x, "transfer_lines", drop_shuffles=True)
    inc = F.col("incoming_school_id")
    return x.select(
        (order * 10 + line).alias("transfer_id"), (part + TEACHER_OFFSET).alias("person_id"),
        (part * RECORD_STEP + inc).alias("employee_id"), (part * RECORD_STEP + out).alias("outgoing_employee_id"),
        out.alias("outgoing_school_id"), inc, (out % 25).alias("outgoing_local_government_id"),
        F.when(line != 7, inc % 25).alias("incoming_local_government_id"),
        F.when(F.col("l_orderkey") % 50 != 0, day).alias("posting_date"),
        F.when(line != 5, F.date_add(day, line * 3 - 4)).alias("reporting_date"), (line % 4).alias("status"),
        F.concat(F.lit("MIN/"), F.col("l_orderkey").cast("string")).alias("appointment_minute_number"),
        line.cast("long").alias("category_id"), day.alias("date_created"), F.date_add(day, line).alias("date_updated"))


TEACHER_TRANSFERS_SQL = f"""teacher_transfers AS (
  SELECT l_orderkey * 10 + l_linenumber AS transfer_id, l_partkey + {TEACHER_OFFSET} AS person_id, l_partkey * {RECORD_STEP} + i.s AS employee_id,
    l_partkey * {RECORD_STEP} + l_suppkey AS outgoing_employee_id, l_suppkey AS outgoing_school_id, i.s AS incoming_school_id,
    l_suppkey % 25 AS outgoing_local_government_id, CASE WHEN l_linenumber <> 7 THEN i.s % 25 END AS incoming_local_government_id,
    CASE WHEN l_orderkey % 50 <> 0 THEN CAST(l_shipdate AS DATE) END AS posting_date,
    CASE WHEN l_linenumber <> 5 THEN CAST(l_shipdate AS DATE) + (l_linenumber * 3 - 4) END AS reporting_date, l_linenumber % 4 AS status,
    'MIN/' || CAST(l_orderkey AS VARCHAR) AS appointment_minute_number, CAST(l_linenumber AS BIGINT) AS category_id,
    CAST(l_shipdate AS DATE) AS date_created, CAST(l_shipdate AS DATE) + l_linenumber AS date_updated
  FROM lineitem JOIN (SELECT l_orderkey, first(l_suppkey ORDER BY l_linenumber, l_suppkey) AS s FROM lineitem GROUP BY l_orderkey) i
  USING (l_orderkey))"""


def teacher_postings(lineitem: DataFrame) -> DataFrame:
    return lineitem.select((F.col("l_partkey") + TEACHER_OFFSET).alias("person_id"), F.col("l_suppkey").alias("school_id"),
                           F.to_date("l_shipdate").alias("posting_date"), (F.col("l_linenumber") % 4).alias("status"))


def local_governments(nation: DataFrame) -> DataFrame:
    """Upper local governments; every 8th hangs on no district."""
    return nation.select(F.col("n_nationkey").cast("long").alias("id"),
                         F.when(F.col("n_nationkey") % 8 != 7, F.col("n_regionkey").cast("long")).alias("district_id"))


def districts(region: DataFrame) -> DataFrame:
    """Districts; the last is archived."""
    return region.select(F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("name"), (F.col("r_regionkey") == 4).alias("is_archived_yn"))


# ---------------------------------------------------------------------------
# Non-teaching staff: part -> staff persons; lineitem -> employee records.
# Staff category and role seed rows.
# ---------------------------------------------------------------------------
NTS_OFFSET = 2_000_000
STAFF_CATEGORIES = [(1, "ADMINISTRATIVE"), (2, "SUPPORT"), (3, "TECHNICAL"), (4, "SECURITY")]
STAFF_ROLES = [(1, "BURSAR", 1), (2, "SECRETARY", 1), (3, "COOK", 2), (4, "CLEANER", 2), (5, "LAB ASSISTANT", 3),
               (6, "ASKARI", 4)]


def nts_lookups(spark: SparkSession) -> dict[str, DataFrame]:
    return {"setting_non_teaching_staff_categories": spark.createDataFrame(STAFF_CATEGORIES, "id long, name string"),
            "setting_non_teaching_staff_roles": spark.createDataFrame(
                STAFF_ROLES, "id long, name string, non_teaching_staff_category_id long")}


NTS_LOOKUPS_SQL = f"""setting_non_teaching_staff_categories AS (SELECT CAST(id AS BIGINT) AS id, name FROM {_values(STAFF_CATEGORIES, ['id', 'name'])}),
setting_non_teaching_staff_roles AS (SELECT CAST(id AS BIGINT) AS id, name, CAST(c AS BIGINT) AS non_teaching_staff_category_id
    FROM {_values(STAFF_ROLES, ['id', 'name', 'c'])})"""


def nts_src(part: DataFrame, lineitem: DataFrame, day: int = 1) -> DataFrame:
    """non_teaching_staff + person fields; current school = smallest supplier
    shipping the part; every 10th has no employee record. Day 2 moves every 5th staff member to role 1 (tracked)
    and renames every 8th (not tracked)."""
    k = F.col("p_partkey")
    first_school = lineitem.groupBy(F.col("l_partkey").alias("p_partkey")) \
        .agg(F.min("l_suppkey").alias("current_school_id"),
             (F.first("l_partkey").cast("long") * RECORD_STEP + F.max("l_suppkey")).alias("__record"))
    role = (F.col("p_size") % 6 + 1)
    surname = F.split_part("p_name", F.lit(" "), F.lit(1))
    if day == 2:
        surname = F.when(k % 8 == 0, F.concat(surname, F.lit("-N"))).otherwise(surname)
        role = F.when(k % 5 == 0, F.lit(1)).otherwise(role)
    return part.join(first_school, "p_partkey", "left").select(
        (k + NTS_OFFSET).alias("person_id"),
        surname.alias("surname"),
        F.col("p_brand").alias("first_name"),
        F.when(k % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        F.when(k % 13 == 0, F.lit(None).cast("date"))
         .otherwise(F.make_date((1970 + k % 30).cast("int"), (1 + k % 12).cast("int"), F.lit(15))).alias("birth_date"),
        "current_school_id",
        (F.col("p_size") % 4 + 1).cast("long").alias("non_teaching_staff_category_id"),
        role.cast("long").alias("non_teaching_staff_role_id"),
        F.make_date((1990 + k % 10).cast("int"), F.lit(1), F.lit(10)).alias("appointment_date"),
        F.when(k % 10 != 0, F.col("__record")).alias("employee_id"),
        F.when(k % 11 != 0, (F.col("p_size") % 25).cast("long")).alias("country_id"),
        F.when(k % 4 != 0, F.concat(F.lit("CM"), k.cast("string"))).alias("id_number"))


def nts_src_sql(day: int = 1, name: str = "nts_src") -> str:
    role = "p.p_size % 6 + 1" if day == 1 else "CASE WHEN p.p_partkey % 5 = 0 THEN 1 ELSE p.p_size % 6 + 1 END"
    surname = "split_part(p.p_name, ' ', 1)"
    if day == 2:
        surname = f"CASE WHEN p.p_partkey % 8 = 0 THEN {surname} || '-N' ELSE {surname} END"
    return f"""{name} AS (SELECT p.p_partkey + {NTS_OFFSET} AS person_id, {surname} AS surname,
  p.p_brand AS first_name, CASE WHEN p.p_partkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CASE WHEN p.p_partkey % 13 = 0 THEN NULL ELSE make_date(CAST(1970 + p.p_partkey % 30 AS INTEGER),
       CAST(1 + p.p_partkey % 12 AS INTEGER), 15) END AS birth_date,
  f.current_school_id, CAST(p.p_size % 4 + 1 AS BIGINT) AS non_teaching_staff_category_id,
  CAST({role} AS BIGINT) AS non_teaching_staff_role_id,
  make_date(CAST(1990 + p.p_partkey % 10 AS INTEGER), 1, 10) AS appointment_date,
  CASE WHEN p.p_partkey % 10 <> 0 THEN f.record END AS employee_id,
  CASE WHEN p.p_partkey % 11 <> 0 THEN CAST(p.p_size % 25 AS BIGINT) END AS country_id,
  CASE WHEN p.p_partkey % 4 <> 0 THEN 'CM' || CAST(p.p_partkey AS VARCHAR) END AS id_number
FROM part p LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS current_school_id, l_partkey * {RECORD_STEP} + max(l_suppkey) AS record
                       FROM lineitem GROUP BY l_partkey) f
  ON f.l_partkey = p.p_partkey)"""


def nts_employees(lineitem: DataFrame) -> DataFrame:
    """The employee records of non-teaching staff."""
    return _employments(lineitem, NTS_OFFSET)


NTS_EMPLOYEES_SQL = _employments_sql("nts_employees", NTS_OFFSET)

"""Teacher transfers (M-X0): both schools, both districts and the teacher of
each transfer, and how long the teacher had been at the outgoing school."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.operators.asof import latest_before_parts
from tessera.operators.joins import BROADCAST_WIDE_ROWS, sized
from tessera.plans.marts.teachers import discipline_counts
from tessera.session import materialize

ROLES = ("outgoing", "incoming")
POSTED = (1, 2)    # fixed values: status codes of postings that took place
SOURCE = ["transfer_id", "person_id", "employee_id", "outgoing_employee_id", "outgoing_school_id", "incoming_school_id", "posting_date",
          "reporting_date", "appointment_minute_number", "category_id", "date_created", "date_updated"]
TEACHER = ["teacher_type", "gender", "qualification", "ipps_number"]


def district_of(local_governments: DataFrame, districts: DataFrame) -> DataFrame:
    """(local government, district_id, district_name); archived districts and
    local governments without one are left out."""
    live = districts.where(~F.col("is_archived_yn")).select(F.col("id").alias("district_id"), F.col("name").alias("district_name"))
    return local_governments.join(live, "district_id").select(F.col("id").alias("local_government_id"), "district_id", "district_name")


def teachers_and_counts(teachers: DataFrame, subjects: DataFrame) -> DataFrame:
    """(__person, TEACHER, counts of subjects), stored: a small table made from
    all employee records and subjects, whose shuffles go before those of the
    transfers are written. A person may be in either table only."""
    known = F.col("person_id").isNotNull()
    rows = teachers.where(known).select("person_id", *TEACHER).join(discipline_counts(subjects.where(known)), "person_id", "full")
    return sized(materialize(rows.withColumnRenamed("person_id", "__person"), "transfer_people", drop_shuffles=True), BROADCAST_WIDE_ROWS)


def transfers_raw(src: DataFrame, schools: DataFrame, school_types: DataFrame, local_governments: DataFrame, districts: DataFrame,
                  postings: DataFrame, teachers: DataFrame, subjects: DataFrame) -> DataFrame:
    """One row per transfer. Unknown schools, local governments and teachers
    leave their columns null; a transfer without a posting date has no days at
    the outgoing school."""
    return transfers_of(src, schools, school_types, local_governments, districts, postings, teachers_and_counts(teachers, subjects))


def transfers_of(src: DataFrame, schools: DataFrame, school_types: DataFrame, local_governments: DataFrame, districts: DataFrame,
                 postings: DataFrame, people: DataFrame) -> DataFrame:
    """``transfers_raw`` with the stored rows of ``teachers_and_counts``."""
    named = sized(schools.join(F.broadcast(school_types.select(F.col("id").alias("school_type_id"), F.col("name").alias("__type"))), "school_type_id", "left")
                  .select(F.col("id").cast("long").alias("__school"), F.col("name").alias("__name"), "__type"))
    places = sized(district_of(local_governments, districts))
    took_place = postings.where(F.col("status").isin(*POSTED)).select(
        F.col("person_id").alias("__p"), F.col("school_id").alias("__s"), F.col("posting_date").alias("__d"))
    # The transfers as they come cross the network once, dealt by person; places are joined last, as their names are wide.
    parts = latest_before_parts(src, took_place, ["person_id", "outgoing_school_id"], ["__p", "__s"], "posting_date", "__d", kind="date",
                                out_time="__last", deal="__deal")
    x = functools.reduce(DataFrame.unionByName, [
        part.join(people, (part["__deal"] == people["__person"]) & part["person_id"].isNotNull(), "left") for part in parts])
    for role in ROLES:
        at = named.select(F.col("__school").alias(f"{role}_school_id"), F.col("__name").alias(f"{role}_school_name"),
                          F.col("__type").alias(f"{role}_school_type"))
        seat = places.select(F.col("local_government_id").alias(f"{role}_local_government_id"),
                             F.col("district_id").alias(f"{role}_district_id"), F.col("district_name").alias(f"{role}_district_name"))
        x = x.join(at, f"{role}_school_id", "left").join(seat, f"{role}_local_government_id", "left")
    places_out = [f"{role}_{c}" for c in ("school_name", "school_type", "district_id", "district_name") for role in ROLES]
    return x.select(
        *SOURCE, *places_out, rules.inter_district("outgoing_district_id", "incoming_district_id").alias("is_inter_district"),
        rules.code_map("status", rules.TRANSFER_STATUS, rules.TRANSFER_STATUS_ELSE).alias("transfer_status"),
        F.datediff("posting_date", "__last").alias("days_at_outgoing_station"),
        *TEACHER, rules.discipline("science_count", "total_subjects").alias("discipline"))

"""Staging of teachers and staff: employee records, documents, fallbacks."""

import datetime as dt

from tessera.plans import eduviews as E
from tessera.plans.marts import nts, teachers

RECORD = ("id long, person_id long, school_id long, date_updated date, weekly_teaching_periods long, hrin string, ipps_number string, "
          "is_on_government_payroll boolean, highest_education_level_id long, employment_status_id long")
DAY = dt.date(2020, 1, 1)


def _lookups(spark):
    return {**E.enrolment_lookups(spark), **E.teacher_lookups(spark), **E.nts_lookups(spark), **E.employment_lookups(spark)}


def _nations(spark):
    return spark.createDataFrame([(1, "KENYA")], "n_nationkey int, n_name string")


def test_teacher_takes_the_record_updated_last_and_own_values_first(spark):
    src = spark.createDataFrame(
        [(1, "A", "x", None, "F", DAY, 1, 5, "IPPS1", None, 1, 2), (2, "B", "y", "z", "M", DAY, 9, None, None, True, None, 3),
         (3, "C", None, None, "M", None, None, 1, None, None, 7, None)],
        "person_id long, surname string, first_name string, other_names string, gender string, birth_date date, teacher_type_id long, "
        "qualification_id long, ipps_number string, is_on_government_payroll boolean, country_id long, designation_id long")
    records = spark.createDataFrame(
        [(10, 1, 5, DAY, 2, "H10", "E10", True, 1, 1), (11, 1, 6, DAY + dt.timedelta(1), 3, "H11", "E11", False, 2, 2),
         (12, 2, 5, None, 4, "H12", "E12", False, None, 9)], RECORD)
    docs = spark.createDataFrame([(1, 1, "n1"), (1, 1, "n2"), (1, 2, "p"), (2, 7, "?"), (2, None, "?")],
                                 "person_id long, identity_type_id long, document_id string")
    got = {r["person_id"]: r for r in teachers.teachers_raw(src, records, docs, _nations(spark), _lookups(spark)).collect()}
    assert len(got) == 3
    a, b, c = got[1], got[2], got[3]
    assert (a["employee_id"], a["hrin"], a["ipps_number"], a["is_on_government_payroll"]) == (11, "H11", "IPPS1", False)
    assert (a["nin"], a["passport_no"], a["nationality"], a["qualification_category"]) == ("n2", "p", "KENYA", "POSTGRADUATE")
    assert (a["highest_education_level"], a["employment_status"], a["designation"]) == ("A LEVEL", "CONTRACT", "DEPUTY HEAD TEACHER")
    assert (b["ipps_number"], b["is_on_government_payroll"], b["nationality"], b["nin"], b["employment_status"]) == ("E12", True, "UGANDA", None, None)
    assert (c["employee_id"], c["ipps_number"], c["is_on_government_payroll"], c["nationality"]) == (None, None, None, "UGANDA")


def test_staff_join_the_record_they_name(spark):
    src = spark.createDataFrame(
        [(1, "A", "x", "F", DAY, 7, 1, 1, DAY, 20, 1, "CM1"), (2, "B", None, "M", None, 7, 2, None, DAY, None, None, None),
         (1, "A", "x", "F", DAY, 7, 1, 2, DAY, 21, 1, "CM1")],
        "person_id long, surname string, first_name string, gender string, birth_date date, current_school_id long, "
        "non_teaching_staff_category_id long, non_teaching_staff_role_id long, appointment_date date, employee_id long, country_id long, id_number string")
    records = spark.createDataFrame([(20, 1, 5, DAY, 0, "H20", "E20", None, 3, 1), (21, 1, 6, DAY + dt.timedelta(1), 0, "H21", None, True, 4, 2),
                                     (22, 2, 8, DAY, 0, "H22", "E22", True, 4, 2)], RECORD)
    got = {r["person_id"]: r for r in nts.nts_raw(src, records, _nations(spark), _lookups(spark)).collect()}
    assert len(got) == 2
    assert (got[1]["employee_id"], got[1]["school_id"], got[1]["staff_role"], got[1]["is_on_government_payroll"], got[1]["employment_status"]) == (
        21, 6, "SECRETARY", True, "CONTRACT")
    assert (got[2]["school_id"], got[2]["is_on_government_payroll"], got[2]["hrin"], got[2]["nationality"]) == (7, False, None, "UGANDA")


def test_tracked_columns_are_in_the_snapshots():
    assert {"designation", "highest_education_level", "qualification_category"} <= set(teachers.TEACHER_TRACKED)
    assert {"highest_education_level", "employment_status", "is_on_government_payroll"} <= set(nts.NTS_TRACKED)

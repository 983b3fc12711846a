"""Transfers staging: places by local government, latest posting, discipline."""

import datetime as dt

from tessera.plans.marts.transfers import transfers_raw

DAY = dt.date(2024, 5, 10)
SRC = ("transfer_id long, person_id long, employee_id long, outgoing_employee_id long, outgoing_school_id long, incoming_school_id long, "
       "outgoing_local_government_id long, incoming_local_government_id long, posting_date date, reporting_date date, status int, "
       "appointment_minute_number string, category_id long, date_created date, date_updated date")


def _frames(spark, rows):
    src = spark.createDataFrame([(i, p, 1, 1, o, n, lo, li, d, DAY, st, "M", 1, DAY, DAY) for i, p, o, n, lo, li, d, st in rows], SRC)
    schools = spark.createDataFrame([(10, "A", 1), (11, "B", 2), (12, "C", None)], "id long, name string, school_type_id long")
    types = spark.createDataFrame([(1, "PRIMARY"), (2, "SECONDARY")], "id long, name string")
    places = spark.createDataFrame([(1, 100), (2, 200), (3, 300), (4, None)], "id long, district_id long")
    districts = spark.createDataFrame([(100, "North", False), (200, "South", False), (300, "Old", True)], "id long, name string, is_archived_yn boolean")
    postings = spark.createDataFrame(
        [(1, 10, dt.date(2024, 1, 1), 1), (1, 10, dt.date(2024, 5, 1), 2), (1, 10, DAY, 2), (1, 10, dt.date(2024, 5, 9), 3), (1, 11, dt.date(2024, 5, 8), 1),
         (None, 10, dt.date(2024, 5, 1), 1)], "person_id long, school_id long, posting_date date, status int")
    teachers = spark.createDataFrame([(1, "LICENSED", "F", "DEGREE", "I1"), (3, None, "M", None, None)],
                                     "person_id long, teacher_type string, gender string, qualification string, ipps_number string")
    subjects = spark.createDataFrame([(1, True), (1, False), (2, True)], "person_id long, is_science_subject boolean")
    return src, schools, types, places, districts, postings, teachers, subjects


def test_transfer_names_places_teacher_and_days(spark):
    rows = [(1, 1, 10, 11, 1, 2, DAY, 2), (2, 2, 11, 12, 1, 1, DAY, 1), (3, 3, 10, 99, 3, 2, DAY, 3), (4, 4, None, 10, 4, None, DAY, 7),
            (5, 1, 10, 11, 1, 2, None, None), (6, None, 10, 10, 1, 9, DAY, 2)]
    got = {r["transfer_id"]: r for r in transfers_raw(*_frames(spark, rows)).collect()}
    assert len(got) == 6
    a = got[1]
    assert (a["outgoing_school_name"], a["incoming_school_type"], a["outgoing_district_name"], a["incoming_district_id"]) == ("A", "SECONDARY", "North", 200)
    # the posting of 1 May counts: not the one of the same day, not a rejected one, not another school's
    assert (a["is_inter_district"], a["days_at_outgoing_station"], a["discipline"], a["transfer_status"]) == (True, 9, "BOTH", "APPROVED")
    b = got[2]
    assert (b["is_inter_district"], b["incoming_school_type"], b["teacher_type"], b["discipline"]) == (False, None, None, "SCIENCE")
    c = got[3]          # archived district, unknown school
    assert (c["outgoing_district_id"], c["incoming_school_name"], c["is_inter_district"], c["gender"], c["discipline"]) == (None, None, False, "M", None)
    assert (got[4]["outgoing_school_name"], got[4]["outgoing_district_id"], got[4]["transfer_status"]) == (None, None, "UNKNOWN")
    assert (got[5]["days_at_outgoing_station"], got[5]["outgoing_school_name"]) == (None, "A")
    assert (got[6]["days_at_outgoing_station"], got[6]["incoming_district_id"], got[6]["ipps_number"]) == (None, None, None)


def test_no_transfers(spark):
    out = transfers_raw(*_frames(spark, []))
    assert out.count() == 0 and len(out.columns) == 28

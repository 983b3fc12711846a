"""Audit event folding, DQ raising and every hierarchy unit type."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import audit as A
from tessera.operators import quality as Q
from tessera.operators.hierarchy import unit_to_district

T = dt.datetime


def test_runs_latest_and_recent(spark):
    ev = spark.createDataFrame([
        (1, dt.date(2025, 1, 1), "RUNNING", T(2025, 1, 1, 1, 0), None, None),
        (1, dt.date(2025, 1, 1), "SUCCESS", T(2025, 1, 1, 1, 18), '{"rows":5}', None),
        (2, dt.date(2025, 1, 2), "RUNNING", T(2025, 1, 2, 1, 0), None, None),
        (2, dt.date(2025, 1, 2), "FAILED", T(2025, 1, 2, 1, 3), None, "boom")],
        "run_id long, as_of date, status string, event_time timestamp_ntz, counts_json string, error string")
    runs = {r.run_id: r for r in A.runs_latest(ev).collect()}
    assert runs[1].status == "SUCCESS" and runs[2].status == "FAILED" and runs[2].error == "boom"
    recent = A.recent_runs(A.runs_latest(ev), 1).collect()
    assert [r.run_id for r in recent] == [2] and recent[0].duration_minutes == 3.0


def test_backfill_result(spark):
    log = spark.createDataFrame([("a", "PASS", None), ("b", "WARN", "WARNING")], "check_name string, status string, result string")
    assert {r.check_name: r.result for r in A.backfill_result(log).collect()} == {"a": "PASS", "b": "WARNING"}


def test_raise_on_fail_after_results(spark):
    df = spark.createDataFrame([(0,)], "n long")
    res = Q.suite(Q.single(df.select(F.lit(3).cast("long").alias("n")), "m", "orphans", Q.FAIL_IF_ANY),
                  Q.single(df, "m", "empty_ok", Q.WARN_IF_ANY))
    summary = Q.summary(res)
    row = summary.first()
    assert (row.checks, row.failed, row.passed) == (2, 1, 1)
    with pytest.raises(RuntimeError):
        Q.raise_on_fail(summary)


def test_every_unit_type_reaches_its_district(spark):
    rows = [(1, 10, "District", "D", None), (2, 20, "County", "C", 10), (3, 30, "Sub County", "S", 20),
            (4, 40, "Parish", "P", 30), (5, 50, "Ward", "W", 30), (6, 60, "Town Council", "T", 20),
            (7, 70, "Municipality", "M", 10), (8, 80, "City", "Ci", 10)]
    u = spark.createDataFrame([r + (True,) for r in rows],
                              "id long, source_id long, admin_unit_type string, name string, child_id long, "
                              "current_status boolean")
    got = sorted((r.unit_dim_id, r.district_dim_id, r.district_name) for r in unit_to_district(u).collect())
    assert got == [(i, 1, "D") for i in range(1, 9)]

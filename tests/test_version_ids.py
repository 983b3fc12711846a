"""Ids of dimension versions: stable over runs, never reused, no fact row lost."""

import datetime as dt

from tessera.operators import scd2
from tessera.operators.version_ids import number_versions, with_version_id
from tessera.plans.marts import schools as S

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))
DIM = "k long, effective_date date"


def _ids(ids):
    return {(r["k"], r["effective_date"]): r["id"] for r in ids.collect()}


def test_known_versions_keep_their_ids(spark):
    one = number_versions(spark.createDataFrame([(2, D1), (1, D1)], DIM), ["k"])
    assert _ids(one) == {(1, D1): 1, (2, D1): 2}
    two = number_versions(spark.createDataFrame([(1, D1), (2, D1), (2, D2), (0, D2)], DIM), ["k"], one)
    assert _ids(two) == {(1, D1): 1, (2, D1): 2, (0, D2): 3, (2, D2): 4}
    again = number_versions(spark.createDataFrame([(1, D1), (2, D1), (2, D2), (0, D2)], DIM), ["k"], two)
    assert _ids(again) == _ids(two)
    # a version that went is remembered: its id is not given to another
    three = number_versions(spark.createDataFrame([(1, D1), (5, D3)], DIM), ["k"], two)
    assert _ids(three)[(5, D3)] == 5 and _ids(three)[(2, D2)] == 4


def test_facts_name_their_versions(spark):
    ids = number_versions(spark.createDataFrame([(1, D1), (1, D2)], DIM), ["k"])
    fact = spark.createDataFrame([(1, D2, "x"), (1, D2, "x"), (1, None, "y"), (None, D1, "z"), (9, D1, "w")], "person long, version date, v string")
    got = sorted((r["v"], r["dim_id"]) for r in with_version_id(fact, ids, {"k": "person"}, "version", "dim_id").collect() if r["dim_id"])
    assert got == [("x", 2), ("x", 2)]
    assert with_version_id(fact, ids, {"k": "person"}, "version", "dim_id").count() == 5
    empty = number_versions(spark.createDataFrame([], DIM), ["k"])
    assert with_version_id(fact, empty, {"k": "person"}, "version", "dim_id").where("dim_id is null").count() == 5


def test_a_new_unit_or_voting_code_opens_a_version(spark):
    unit = "source_id long, admin_unit_type string, name string, admin_unit_code string, voting_code string, child_id long"
    first = spark.createDataFrame([(1, "County", "C", "CO/1", None, 9), (2, "County", "D", "CO/2", "V2", 9), (3, "Ward", "W", "WA/3", "V3", 1)], unit)
    later = spark.createDataFrame([(1, "County", "C", "CO/1", "V1", 9), (2, "County", "D", "CO/2b", "V2", 9), (3, "Ward", "W", "WA/3", "V3", 1)], unit)
    dim = S.admin_units_scd2(S.admin_units_scd2(None, first, D1), later, D2)
    rows = {(r["source_id"], r["current_status"]): r["changed_fields"] for r in dim.collect()}
    assert len(rows) == 5 and rows[(1, True)] == "voting_code" and rows[(2, True)] == "admin_unit_code"
    assert scd2.scd2_gaps(dim.withColumnRenamed("current_status", "is_current"), ["source_id", "admin_unit_type"]).count() == 0

"""Scenario cases (FIXTURES §D) on tiny hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.operators import quality as Q
from tessera.operators import scd2
from tessera.operators.asof import asof_version, latest_before
from tessera.operators.calendar import date_dim
from tessera.operators.dedupe import pick_one, unique_or_null
from tessera.operators.facts import load_fact_fallback
from tessera.operators.hierarchy import unit_to_district
from tessera.operators.merge import insert_if_absent, upsert

D = dt.date
RULES = [("name", "School renamed"), ("boarding", "Boarding status changed")]


def _merge(spark, dim, rows, day):
    snap = spark.createDataFrame(rows, "source_id long, name string, boarding string")
    if dim is None:
        dim = scd2.empty_dim(spark, snap, ["source_id", "name", "boarding"])
    return scd2.scd2_merge(dim, snap, ["source_id"], ["name", "boarding"], day,
                           reason_rules=RULES, initial_fields="ALL")


def _rows(df):
    return sorted((tuple(r) for r in df.select("source_id", "name", "boarding", "effective_date",
                                              "expiration_date", "is_current", "change_reason",
                                              "changed_fields").collect()), key=str)


def test_scd2_sequence(spark):
    d1 = _merge(spark, None, [(1, "A", "DAY"), (2, "B", None)], "2025-01-10")
    assert _rows(d1) == sorted([(1, "A", "DAY", D(2025, 1, 10), D(9999, 12, 31), True, "INITIAL_LOAD", "ALL"),
                                (2, "B", None, D(2025, 1, 10), D(9999, 12, 31), True, "INITIAL_LOAD", "ALL")], key=str)
    d2 = _merge(spark, d1, [(1, "A2", "DAY"), (2, "B", None), (3, "C", "DAY")], "2025-03-05")
    r2 = _rows(d2)
    assert (1, "A", "DAY", D(2025, 1, 10), D(2025, 3, 4), False, "INITIAL_LOAD", "ALL") in r2
    assert (1, "A2", "DAY", D(2025, 3, 5), D(9999, 12, 31), True, "School renamed", "name") in r2
    assert (3, "C", "DAY", D(2025, 3, 5), D(9999, 12, 31), True, "INITIAL_LOAD", "ALL") in r2
    assert len(r2) == 4
    replay = _merge(spark, d2, [(1, "A2", "DAY"), (2, "B", None), (3, "C", "DAY")], "2025-03-05")
    assert _rows(replay) == r2
    d3 = _merge(spark, d2, [(1, "A2", "DAY"), (2, "B", "BOARD")], "2025-06-01")
    r3 = _rows(d3)
    assert (2, "B", None, D(2025, 1, 10), D(2025, 5, 31), False, "INITIAL_LOAD", "ALL") in r3
    assert (2, "B", "BOARD", D(2025, 6, 1), D(9999, 12, 31), True, "Boarding status changed", "boarding") in r3
    # key 3 is absent from the snapshot and stays current
    assert (3, "C", "DAY", D(2025, 3, 5), D(9999, 12, 31), True, "INITIAL_LOAD", "ALL") in r3


def test_scd2_same_day_change_replaces(spark):
    d1 = _merge(spark, None, [(1, "A", "DAY")], "2025-01-10")
    d2 = _merge(spark, d1, [(1, "B", "DAY")], "2025-02-01")
    d3 = _merge(spark, d2, [(1, "C", "DAY")], "2025-02-01")
    r = _rows(d3)
    assert len(r) == 2
    assert all(row[4] >= row[3] for row in r)  # expiration never before effective
    assert (1, "C", "DAY", D(2025, 2, 1), D(9999, 12, 31), True, "School renamed", "name") in r


def test_scd2_properties(spark):
    """Random snapshots: one current row per key, versions tile, replay is a no-op."""
    import random
    rnd = random.Random(7)
    dim = None
    days = ["2025-01-01", "2025-02-01", "2025-03-01", "2025-04-01"]
    for day in days:
        rows = [(k, rnd.choice(["a", "b", None]), rnd.choice(["x", None])) for k in range(1, 30)
                if rnd.random() > 0.2]
        dim = _merge(spark, dim, rows, day)
        dim = spark.createDataFrame(dim.collect(), dim.schema)  # cut lineage for the test
    assert Q.duplicate_count(dim.where("is_current"), ["source_id"], "t", "dup").first()["row_count"] == 0
    assert scd2.scd2_gaps(dim, ["source_id"]).count() == 0
    last = [(r.source_id, r.name, r.boarding) for r in dim.where("is_current").collect()]
    again = _merge(spark, dim, last, "2025-05-01")
    assert again.count() == dim.count()


def test_asof_boundary_and_fallback(spark):
    dim = spark.createDataFrame(
        [(1, 10, D(2025, 1, 10), D(2025, 3, 4)), (1, 11, D(2025, 3, 5), D(2025, 5, 31)),
         (1, 12, D(2025, 6, 1), D(9999, 12, 31)), (7, 70, D(2025, 1, 1), D(9999, 12, 31))],
        "source_id long, id long, effective_date date, expiration_date date")
    f = spark.createDataFrame([(1, D(2025, 5, 31)), (1, D(2024, 12, 31))], "k long, d date")
    closed = asof_version(f, dim, "k", "source_id", "d", ["id"], "v", closed=True)
    assert sorted((r.d, r.v_id) for r in closed.collect()) == [(D(2024, 12, 31), None), (D(2025, 5, 31), 11)]
    half = asof_version(f, dim, "k", "source_id", "d", ["id"], "v", closed=False)
    assert sorted((r.d, r.v_id) for r in half.collect()) == [(D(2024, 12, 31), None), (D(2025, 5, 31), None)]
    # all-or-nothing: learner resolves as of, school (key 7) does not before 2025 -> both earliest
    flat = spark.createDataFrame([(1, 7, D(2025, 4, 1)), (1, 7, D(2024, 6, 1))], "l long, s long, d date")
    school = dim.where("source_id = 7").withColumn("effective_date", F.lit(D(2024, 7, 1)))
    out = load_fact_fallback(flat, [dict(dim=dim, fact_key="l", dim_key="source_id", take=["id"], prefix="ln"),
                                    dict(dim=school, fact_key="s", dim_key="source_id", take=["id"], prefix="sc")],
                             "d")
    got = sorted((r.d, r.ln_id, r.sc_id, r.resolution) for r in out.collect())
    assert got == [(D(2024, 6, 1), 10, 70, "EARLIEST"), (D(2025, 4, 1), 11, 70, "ASOF")]


def test_conflict_keys(spark):
    tgt = spark.createDataFrame([(1, "a", 1.0), (None, "n", 0.0)], "k long, v string, x double")
    inc = spark.createDataFrame([(1, "b", 2.0), (2, "c", None), (2, "d", 4.0), (None, "m", 5.0)],
                                "k long, v string, x double")
    ins = sorted((tuple(r) for r in insert_if_absent(tgt, inc, ["k"], order=["v"]).collect()), key=str)
    assert ins == sorted([(1, "a", 1.0), (None, "n", 0.0), (2, "c", None), (None, "m", 5.0)], key=str)
    inc2 = spark.createDataFrame([(1, "b", None), (3, "z", 9.0)], "k long, v string, x double")
    up = {(r.k, r.v): r.x for r in upsert(tgt, inc2, ["k"], update_cols=["x"]).collect()}
    assert up[(1, "a")] is None  # incoming NULL overwrites, v kept
    assert up[(3, "z")] == 9.0 and up[(None, "n")] == 0.0


def test_unique_code_filter(spark):
    df = spark.createDataFrame([(1, "X"), (2, "X"), (3, "Y"), (4, None), (5, None)], "id int, code string")
    assert sorted(r.id for r in unique_or_null(df, "code").collect()) == [3, 4, 5]


def test_year_term_rules(spark):
    df = spark.createDataFrame([("ACADEMIC YEAR 2026", "2", D(2026, 2, 1)), ("Old", "term 3", D(2024, 9, 2)),
                                ("2025", "X", D(2025, 1, 1)), ("", None, D(2023, 5, 1))],
                               "n string, p string, s date")
    out = [(r.y, r.t) for r in df.select(rules.academic_year("n", "s").alias("y"),
                                         rules.term_label("p").alias("t")).collect()]
    assert out == [(2026, "TERM 2"), (2024, "TERM 3"), (2025, "TERM 1"), (2023, "TERM 1")]


def test_boarding_and_sex_matrix(spark):
    vals = [True, False, None]
    rows = [(i, d, b) for i, (d, b) in enumerate((d, b) for d in vals for b in vals)]
    df = spark.createDataFrame(rows, "id int, d boolean, b boolean").withColumn("p", F.lit(1))
    got = {(r.d, r.b): r.s for r in df.select("d", "b", rules.boarding_status([("p", "d", "b")]).alias("s")).collect()}
    assert got[(True, False)] == "DAY SCHOOL" and got[(False, True)] == "FULLY BOARDING"
    assert got[(True, True)] == "DAY AND BOARDING"
    assert sum(v is not None for v in got.values()) == 3
    sx = {(r.d, r.b): r.s for r in df.select("d", "b", rules.sex_composition("d", "b").alias("s")).collect()}
    assert sx[(True, None)] == "FEMALES ONLY" and sx[(False, False)] is None


def test_discipline_and_days_at_station(spark):
    df = spark.createDataFrame([(2, 2), (0, 3), (1, 3), (None, None)], "s long, t long")
    assert [r.x for r in df.select(rules.discipline("s", "t").alias("x")).collect()] == \
        ["SCIENCE", "ARTS", "BOTH", None]
    posts = spark.createDataFrame([(1, 9, D(2024, 1, 10), 1), (1, 9, D(2024, 6, 1), 3), (1, 9, D(2025, 2, 1), 1),
                                   (1, 9, D(2024, 9, 1), 2)], "p long, s long, d date, st int")
    tr = spark.createDataFrame([(1, 9, D(2024, 9, 1))], "p long, s long, d date")
    out = latest_before(tr, posts.where("st in (1, 2)"), ["p", "s"], ["p", "s"], "d", "d", bucket=16)
    r = out.withColumn("days", F.datediff("d", "prev_time")).first()
    assert r.days == 235  # from 2024-01-10; status 3, same-day and later postings ignored


def test_hierarchy(spark):
    u = spark.createDataFrame([
        (1, 100, "District", "D", None, True), (2, 200, "County", "C", 100, True),
        (3, 300, "Sub County", "S", 200, True), (4, 400, "Parish", "P", 300, True),
        (5, 500, "Village", "V", 400, True), (6, 600, "City", "Ci", 100, True),
        (7, 700, "County", "Cx", 100, False), (8, 800, "Sub County", "Sx", 700, True),
        (9, 900, "Parish", "Orphan", 999, True)],
        "id long, source_id long, admin_unit_type string, name string, child_id long, current_status boolean")
    got = sorted((r.unit_dim_id, r.district_dim_id) for r in unit_to_district(u).collect())
    assert got == [(1, 1), (2, 1), (3, 1), (4, 1), (6, 1)]


def test_rates_and_parity(spark):
    df = spark.createDataFrame([(60, 50), (40, 50), (100, 100), (5, 0), (82, 80)], "n long, d long")
    assert [r.g for r in df.select(rules.rate("n", "d").alias("g")).collect()] == [120.0, 80.0, 100.0, None, 102.5]
    assert df.select(rules.rate("n", "d", scale=1).alias("g")).collect()[4].g == 1.03  # exact half-up
    p = spark.createDataFrame([(80.0, 120.0), (None, 10.0), (5.0, 0.0)], "f double, m double")
    assert [r.x for r in p.select(rules.parity("f", "m").alias("x")).collect()] == [0.6667, 0.0, None]


def test_area_and_date_dim(spark):
    a = spark.createDataFrame([(None,), (-1.0,), (1e14,), (12.345,)], "a double")
    assert [r.x for r in a.select(rules.area_clean("a").alias("x")).collect()] == [None, None, None, 12.35]
    b = spark.createDataFrame([(D(2022, 1, 1), D(2037, 12, 31))], "start_date date, end_date date")
    dd = date_dim(b)
    assert dd.count() == 5844
    r = {x.system_date: x for x in dd.where("system_date in ('2025-06-30', '2025-07-01')").collect()}
    assert (r[D(2025, 6, 30)].FY, r[D(2025, 6, 30)].Quarter) == (2025, "Q4")
    assert (r[D(2025, 7, 1)].FY, r[D(2025, 7, 1)].Quarter, r[D(2025, 7, 1)].month_name,
            r[D(2025, 7, 1)].short_month) == (2026, "Q1", "July     ", "JUL")


def test_dq_variance_thresholds(spark):
    def one(n):
        return spark.createDataFrame([(n,)], "n long")
    st = [Q.variance(one(f), one(s), "m", "v").first().status for f, s in [(99, 100), (995, 1000), (5, 0)]]
    assert st == ["WARNING", "PASS", "WARNING"]


def test_pick_one_null_order(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 5, 2), (1, 3, 3)], "k int, o int, v int")
    assert pick_one(df, ["k"], [("o", "desc", "last")], ["v"]).first().v == 2
    assert pick_one(df, ["k"], [("o", "desc", "first")], ["v"]).first().v == 1
    assert pick_one(df, ["k"], [("o", "asc", "last")], ["v"]).first().v == 3
    assert pick_one(df, ["k"], [("o", "asc", "first")], ["v"]).first().v == 1

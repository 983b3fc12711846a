"""What a transfer table of any size shuffles: its rows twice (by order and by
person), counts by hash instead of by key, and shuffles that go in time."""

import datetime as dt
import re

from pyspark.sql import functions as F

from tessera.operators import asof
from tessera.plans import eduviews as E
from tessera.plans import views as V
from tessera.plans.marts.transfers import transfers_raw
from tessera.session import DROP_SHUFFLES, materialize

DAY = dt.date(2024, 5, 10)
SRC = ("transfer_id long, person_id long, employee_id long, outgoing_employee_id long, outgoing_school_id long, incoming_school_id long, "
       "outgoing_local_government_id long, incoming_local_government_id long, posting_date date, reporting_date date, status int, "
       "appointment_minute_number string, category_id long, date_created date, date_updated date")


def _rows(df):
    return sorted(map(repr, df.collect()))


def _crossed(df, scanned):
    """How often the rows of the scan with a column of that name are shuffled."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(re.match(r"[ :+\-]*", x)[0]) for x in lines]
    below = lambda i: lines[i + 1:next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))]
    return sum("Exchange hashpartitioning" in x and any("Scan" in y and scanned in y for y in below(i)) for i, x in enumerate(lines))


def _frames(spark):
    src = spark.createDataFrame([(i, i % 3 or None, 1, 1, 10, 11, 1, 2, DAY, DAY, 2, "M", 1, DAY, DAY) for i in range(60)], SRC)
    schools = spark.createDataFrame([(10, "A", 1), (11, "B", 2)], "id long, name string, school_type_id long")
    types = spark.createDataFrame([(1, "PRIMARY")], "id long, name string")
    places = spark.createDataFrame([(1, 100), (2, 200)], "id long, district_id long")
    districts = spark.createDataFrame([(100, "North", False), (200, "South", False)], "id long, name string, is_archived_yn boolean")
    postings = spark.createDataFrame([(1, 10, dt.date(2024, 5, 1), 1), (None, 10, dt.date(2024, 5, 1), 1)],
                                     "person_id long, school_id long, posting_date date, status int")
    # person 1 is two teachers' number, nobody's number is no transfer's person
    teachers = spark.createDataFrame([(1, "LICENSED", "F", "DEGREE", "I1"), (1, "LICENSED", "M", "PHD", "I2"), (None, "VOLUNTEER", "M", None, "I3")],
                                     "person_id long, teacher_type string, gender string, qualification string, ipps_number string")
    subjects = spark.createDataFrame([(1, True), (2, False), (None, True)], "person_id long, is_science_subject boolean")
    return src, schools, types, places, districts, postings, teachers, subjects


def test_transfers_are_shuffled_once_and_repeated_or_missing_persons_stay(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = transfers_raw(*_frames(spark))
        assert _crossed(out, "appointment_minute_number") == 1
        got = out.groupBy("person_id", "gender", "discipline", "days_at_outgoing_station", "outgoing_district_name").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert _rows(got) == sorted(map(repr, spark.createDataFrame(
        [(1, "F", "SCIENCE", 9, "North", 20), (1, "M", "SCIENCE", 9, "North", 20), (2, None, "ARTS", None, "North", 20), (None, None, None, None, "North", 20)],
        "person_id long, gender string, discipline string, days_at_outgoing_station int, outgoing_district_name string, count long").collect()))


def test_a_large_table_of_people_is_merged_without_another_shuffle_of_the_transfers(spark, monkeypatch):
    from tessera.plans.marts import transfers
    small = _rows(transfers_raw(*_frames(spark)))
    monkeypatch.setattr(transfers, "sized", lambda table, limit=0: table.hint("merge") if "__person" in table.columns else F.broadcast(table))
    out = transfers_raw(*_frames(spark))
    assert "SortMergeJoin [__deal" in out._jdf.queryExecution().executedPlan().toString()
    assert _crossed(out, "appointment_minute_number") == 1
    assert _rows(out) == small


def test_dealt_rows_agree_with_all_keys_and_hot_ones(spark):
    day = lambda c: F.date_add(F.lit("1969-12-01").cast("date"), c.cast("int"))  # noqa: E731  days before and after the first
    i = F.col("id")
    rows = spark.range(600).select(F.when(i % 50 != 0, i % 5).alias("p"), F.when(i % 13 != 0, i % 3).alias("s"), F.when(i % 31 != 0, day(i * 7 % 90)).alias("d"), i.alias("v"))
    cands = rows.where("v % 3 < 2").select(F.col("p").alias("cp"), F.col("s").alias("cs"), F.col("d").alias("cd"), F.col("v").alias("w"))
    for strict in (True, False):
        args = (rows, cands, ["p", "s"], ["cp", "cs"], "d", "cd", ["w"], strict)
        expected = _rows(asof.latest_before(*args))
        for n, parts in ((10 ** 6, 1), (150, 2), (0, 2)):
            got = asof.latest_before_parts(*args, hot_rows=n, deal="__deal")
            assert len(got) == parts
            assert sorted(x for part in got for x in _rows(part.drop("__deal"))) == expected
            assert all(part.where("p <> __deal").count() == 0 for part in got)
    # rows of no person are spread, those of a person are together
    deals = got[0].groupBy("p").agg(F.count_distinct("__deal").alias("n")).collect()
    assert {r["p"]: r["n"] for r in deals}[None] == 12
    without = asof.latest_before_parts(rows.select("p", "s", "d"), cands, ["p", "s"], ["cp", "cs"], "d", "cd", deal="__deal")
    assert _rows(without[0].drop("__deal")) == _rows(asof.latest_before(rows.select("p", "s", "d"), cands, ["p", "s"], ["cp", "cs"], "d", "cd"))


def test_hot_keys_are_counted_by_hash_first(spark, monkeypatch):
    stored = {}
    monkeypatch.setattr(asof, "materialize", lambda df, name, **how: stored.setdefault(name, materialize(df, name, **how)))
    keys = spark.range(1000).select(F.when(F.col("id") < 40, F.lit(7)).otherwise(F.col("id")).alias("a"), F.lit("x").alias("b"))
    assert asof._hot_keys(keys, 40) is None and set(stored) == {"full_spots"}
    stored.clear()
    assert [tuple(r) for r in asof._hot_keys(keys, 39).collect()] == [(7, "x")]
    assert stored["full_spots"].count() < 10
    monkeypatch.setattr(asof, "SPOTS", 4)       # full by many keys, none of them hot
    stored.clear()
    assert asof._hot_keys(keys.where("a <> 7"), 100) is None and set(stored) == {"full_spots", "hot_keys"}


def test_first_lines_are_found_among_an_orders_lines(spark):
    rows = [(1, 1, 30, 2, "2024-01-01"), (1, 2, 20, 1, "2024-01-02"), (1, 3, 10, 1, "2024-01-03"), (2, 4, 5, None, "2024-01-04"), (2, 5, 6, 1, None),
            (3, None, None, 1, "2024-01-05"), (3, 6, 8, 2, "2024-01-05"), (None, 7, 9, 1, "2024-01-06"), (None, 7, 9, 1, "2024-01-06"), (4, 8, 7, 3, "2024-01-07"),
            (4, 8, 7, 3, "2024-01-07")]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate string") \
                 .withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))
    first = {r["o"]: r["s"] for r in V.first_supplier(lines, "o", "s").collect() if r["o"] is not None}
    assert first == {1: 10, 2: 5, 3: None, 4: 7}
    got = E.teacher_transfers(lines)
    seen = [tuple(r) for r in got.select("appointment_minute_number", "outgoing_school_id", "incoming_school_id").collect()]
    assert sorted(seen, key=repr) == sorted(((f"MIN/{o}" if o else None, s, first.get(o)) for o, _, s, _, _ in rows), key=repr)


def test_stored_rows_outlive_their_shuffles(spark):
    status = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    shuffles = lambda: set(status.keySet().mkString(",").split(","))
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    before, setting = shuffles(), spark.conf.get(DROP_SHUFFLES, None)
    stored = materialize(rows, "stored", drop_shuffles=True)
    assert shuffles() <= before and spark.conf.get(DROP_SHUFFLES, None) == setting
    assert _rows(stored) == _rows(rows) and len(_rows(stored)) == 10

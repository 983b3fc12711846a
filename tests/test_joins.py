"""Join helpers: calendar fan-out, OR-join split."""

from pyspark.sql import functions as F

from tessera.operators.joins import expand_over, or_join_terms


def test_expand_over_and_empty_table(spark):
    staff = spark.createDataFrame([(1,), (2,)], "s long")
    terms = spark.createDataFrame([(2024, "TERM 1"), (2024, "TERM 2"), (2025, "TERM 1")], "y int, t string")
    assert expand_over(staff, terms).count() == 6
    assert expand_over(staff, terms.where("y > 3000")).count() == 0


def test_or_join_split_equals_or_predicate(spark):
    people = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "p long, school long")
    cal = spark.createDataFrame([(100, None), (101, 10), (102, 30), (103, None)], "term long, cal_school long")
    split = sorted(tuple(r) for r in or_join_terms(people, cal, "school", "cal_school").select("p", "term").collect())
    cond = F.col("cal_school").isNull() | (F.col("cal_school") == F.col("school"))
    direct = sorted(tuple(r) for r in people.join(cal, cond).select("p", "term").collect())
    assert split == direct


def test_a_calendar_of_any_length(spark):
    """20,000 terms, global ones and ones of a school: no cap, no join of all pairs."""
    people = spark.createDataFrame([(1, 10), (2, 20)], "p long, school long")
    cal = spark.range(20_000).select(F.col("id").alias("term"), F.when(F.col("id") % 2 == 1, F.lit(10)).cast("long").alias("cal_school"))
    assert expand_over(people, cal).count() == 40_000
    out = or_join_terms(people, cal, "school", "cal_school")
    assert {r["p"]: r["count"] for r in out.groupBy("p").count().collect()} == {1: 20_000, 2: 10_000}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan

"""Steps that grow with the tables: the calendar reduced before a snapshot's
fan-out, one aggregate for a person's record and school, updates picked before
their codes are resolved, texts normalised without a regular expression."""

from pyspark.sql import functions as F

from tessera.llm import exact_dedup as X
from tessera.plans import eduviews as E
from tessera.plans import q_edu as Q
from tessera.plans import views as V
from tessera.plans.marts import teachers as TE
from tessera.plans.registry import Tables

BASE = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_snapshots_from_the_last_terms_are_those_from_all_terms(spark):
    cal = spark.createDataFrame(
        [(1, 1, 1, None, 1, "2024-02-01", "active"), (2, 1, 2, None, 1, "2024-06-01", "active"), (3, 1, 3, None, 1, None, "active"),
         (4, 9, 1, None, 1, "2030-01-01", "active"), (5, 1, 1, 7, 1, "2024-09-01", "active"), (6, 1, 2, 8, 1, "2024-01-01", "active"),
         (7, 1, 2, 7, 1, "2025-01-01", "inactive"), (8, 9, 2, 7, 1, "2031-01-01", "active")],
        "id long, academic_year_id long, teaching_period_id long, school_id long, school_type_id long, start_date string, status string"
    ).withColumn("start_date", F.col("start_date").cast("date"))
    years = spark.createDataFrame([(1, "ACADEMIC YEAR 2024")], "id long, name string")    # none with id 9
    terms = TE.labelled(TE.active_calendar(cal), years, V.teaching_periods(spark))
    last = {r["cal_school"]: str(r["term_start_date"]) for r in TE.last_terms(terms).collect()}
    assert last == {None: "2024-06-01", 7: "2024-09-01", 8: "2024-01-01"}
    assert TE.last_terms(terms.where("false")).count() == 0
    t = Tables(spark, BASE)
    order = [("term_start_date", "desc", "last"), ("school_id", "desc")]
    for flat, columns in ((Q.teachers_flat, TE.TEACHER_TRACKED + TE.TEACHER_EXTRA), (Q.nts_flat, Q.NT.NTS_TRACKED + Q.NT.NTS_EXTRA)):
        all_terms, last_terms = flat(spark, t, 2, Q.T_RUN2), flat(spark, t, 2, Q.T_RUN2, last=True)
        assert last_terms.count() <= 2 * t.part.count() < all_terms.count()
        snaps = [Q.pick_one(f, ["person_id"], order, ["term_start_date", "academic_year", "term", *columns]) for f in (all_terms, last_terms)]
        assert _rows(snaps[0]) == _rows(snaps[1])


def test_a_persons_record_and_school_come_from_one_aggregate(spark):
    t, lookups = Tables(spark, BASE), E.employment_lookups(spark)
    lines = t.lineitem.select(F.when(F.col("l_linenumber") != 7, F.col("l_partkey")).alias("l_partkey"),
                              F.when(F.col("l_linenumber") != 6, F.col("l_suppkey")).alias("l_suppkey"),
                              F.when(F.col("l_linenumber") != 5, F.col("l_shipdate")).alias("l_shipdate"))
    employees = E.school_employees(lines)
    one = TE.records_and_schools(employees, lookups)
    two = TE.latest_record(employees, lookups).join(TE.current_school(employees).select("person_id", "school_id"), "person_id")
    assert _rows(one) == _rows(two.select(*one.columns)) and one.count() > 100
    aggregates = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [")
    assert (aggregates(one), aggregates(two)) == (2, 4)


def test_building_updates_are_picked_before_their_codes_are_resolved(spark):
    plan = Q._infra_raw(spark, Tables(spark, BASE))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CASE WHEN") < plan.index("Aggregate")


def test_white_space_is_normalised_without_matching_every_word(spark):
    texts = ["", " ", "a b", "a\tb\n\n c", "\r\n\v\fx  y ", "  ", "a\u00a0b\u2028c", "\u0001 \u0001", "é\n𝒳 \t 𝒳", None]
    df = spark.createDataFrame([(x,) for x in texts], "text string")
    got = df.select(X.normalised("text").alias("got"), F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", " ").alias("want"))
    assert all(r["got"] == r["want"] for r in got.collect())
    assert "x09" not in got.select("got")._jdf.queryExecution().optimizedPlan().toString()
    cut = df.select(X.cut_blocks(X.normalised("text"), 2).alias("b"), X.normalised("text").alias("t"))
    assert all("".join(r["b"]) == r["t"] and all(len(x) == 2 for x in r["b"][:-1]) for r in cut.collect())

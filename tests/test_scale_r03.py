"""Steps that grow with the tables: no broadcast of stored rows judged by their
files, staging stored before the fan-out over terms, latest-before."""

from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.operators import quality as DQ
from tessera.plans import q_edu as Q
from tessera.plans.registry import Tables
from tessera.session import materialize

BASE = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unmatched_counts_rows_and_null_keys_without_a_join(spark):
    left = materialize(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "b"), (3, None)], "k int, s string"))
    right = materialize(spark.createDataFrame([(2, "b"), (2, "b"), (None, "b"), (9, "a")], "k long, s string"))
    n = DQ.unmatched(left, right, ["k", "s"])
    assert n.first()["n"] == left.join(right, ["k", "s"], "left_anti").count() == 4
    assert "Join" not in _plan(n)
    assert DQ.unmatched(left.where("k > 100"), right, ["k"]).first()["n"] == 0


def test_a_stored_table_of_many_rows_is_merged_although_its_file_is_small(spark):
    facts = materialize(spark.range(3000).select((F.col("id") % 7).alias("k"), F.lit(1).alias("v")))
    dim = materialize(spark.range(2000).select((F.col("id") % 7).alias("k"), F.lit(2).alias("w")).distinct())
    big = materialize(spark.range(2000).select(F.lit(3).cast("long").alias("k")))
    assert "BroadcastHashJoin" in _plan(facts.join(big.distinct(), "k"))
    assert "SortMergeJoin" in _plan(facts.join(J.sized(big, limit=100).distinct(), "k"))
    assert "BroadcastHashJoin" in _plan(facts.join(J.sized(dim, limit=100), "k"))


def test_flat_staging_is_stored_before_the_terms(spark, monkeypatch):
    stored = {}

    def counted(df, name="step"):
        out = materialize(df, name)
        stored.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(Q, "materialize", counted)
    t = Tables(spark, BASE)
    flats = [Q.teachers_flat(spark, t, 2, Q.T_RUN2), Q.nts_flat(spark, t, 2, Q.T_RUN2)]
    Q.teachers_flat(spark, t, 1, Q.T_RUN1)
    people = t.part.count()
    assert all(f.count() > 5 * people for f in flats)
    assert max(n for name, runs in stored.items() for n in runs if name != "term_calendar") <= people
    assert {name: len(runs) for name, runs in stored.items()} == {
        "teacher_records": 1, "teacher_identities": 1, "subject_counts": 1, "term_calendar": 1, "academic_years": 1,
        "teachers_staffed": 2, "nts_raw": 1}


def test_latest_before_shuffles_its_probes_once_and_hot_keys_agree(spark):
    from tessera.operators.asof import latest_before
    rows = spark.range(600).select((F.col("id") % 5).alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7 % 90).cast("int")).alias("d"),
                                   F.col("id").alias("v"))
    rows = rows.select(F.when(F.col("v") % 50 != 0, F.col("k")).alias("k"), F.when(F.col("v") % 31 != 0, F.col("d")).alias("d"), "v")
    cands = rows.where("v % 3 = 0").select(F.col("k").alias("ck"), F.col("d").alias("cd"), F.col("v").alias("w"))
    for strict in (True, False):
        run = lambda n: latest_before(rows, cands, ["k"], ["ck"], "d", "cd", values=["w"], strict=strict, hot_rows=n)  # noqa: E731, B023
        got = [sorted(map(str, run(n).collect())) for n in (10 ** 6, 150, 0)]
        assert got[0] == got[1] == got[2] and len(got[0]) == 600
    assert "Join" not in _plan(run(10 ** 6))


def test_a_climb_ends_when_only_cycles_are_left(spark, monkeypatch):
    from tessera.operators import tree
    stored = []
    monkeypatch.setattr(tree, "materialize", lambda df, name: stored.append(materialize(df, name)) or stored[-1])
    # chains of 8 below a root, and 4,000 nodes below a node that is its own parent
    rows = [(i, None if i % 8 == 0 else i - 1, "n") for i in range(64)] + [(100, 100, "n")] + [(i, 100, "n") for i in range(101, 4101)]
    out = tree.climb(spark.createDataFrame(rows, "id long, parent long, kind string"), "id", "parent", "kind", ("click",))
    got = {r["status"]: r["n"] for r in out.groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert got == {"OK": 64, "CYCLE": 4001} and out.where("status = 'OK'").agg(F.max("depth")).first()[0] == 7
    assert len(stored) <= 6 and stored[-1].count() == 4001


def test_bitmaps_of_scattered_members_are_small(spark):
    from tessera.operators import coverage
    rows = spark.createDataFrame([(1, 5), (1, 10 ** 6), (1, -3), (2, 5), (2, 63), (2, 64), (2, None)], "g int, m long")
    bits = coverage.bitmaps(rows, ["g"], "m")
    assert bits.schema["seen"].dataType.typeName() == "long"
    assert {r["g"]: r["n"] for r in coverage.distinct_counts(bits, ["g"], {"n": None}).collect()} == {1: 3, 2: 3}
    assert coverage.distinct_counts(bits, [], {"n": None}).first()["n"] == 5

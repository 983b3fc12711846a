"""Stored tables, stored dimensions, hierarchies, roll-ups, observed writes,
error rows and the stream of newest rows."""

import datetime
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import coverage, errors, merge, tree
from tessera.operators.scd2 import empty_dim, scd2_merge
from tessera.operators.stored import StoredTable
from tessera.operators.stored_dim import StoredDimension
from tessera.plans.marts import infrastructure as IN
from tessera.session import checkpoint_dir
from tessera.sources import copy, versions
from tessera.streaming.latest import latest_watermark, run_latest

SCHEMA = "k long, y int, v string, kept string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("partition_by", ["y", None])
def test_upsert_equals_the_rebuilt_table(spark, partition_by):
    first = spark.createDataFrame([(i, 2000 + i % 5, "a", "first") for i in range(100)] + [(None, 2001, "n", "x"), (7, None, "n", "y")], SCHEMA)
    second = spark.createDataFrame([(i, 2000 + i % 5, None if i % 2 else "b", "second") for i in range(90, 130)], SCHEMA)
    table = StoredTable(spark, "t", first.schema, ["k", "y"], partition_by=partition_by, parts=8)
    table.upsert(first)
    table.upsert(second, ["v"])
    want = merge.upsert(first, second, ["k", "y"], ["v"])
    assert rows_of(table.read()) == rows_of(want)
    table.upsert(second, ["v"])
    assert rows_of(table.read()) == rows_of(want)


def test_untouched_partitions_keep_their_files(spark):
    first = spark.createDataFrame([(i, 2000 + i % 5, "a", "x") for i in range(50)], SCHEMA)
    table = StoredTable(spark, "t", first.schema, ["k", "y"], partition_by="y")
    table.upsert(first)
    before = table.files()
    assert table.upsert(first.where("y = 2003").withColumn("v", F.lit("b"))) == [2003]
    after = table.files()
    assert {p for p in before if before[p] != after[p]} == {"y=2003"} and set(after) == set(before)
    assert table.upsert(first.where("false")) == [] and table.files() == after
    added = spark.createDataFrame([(1, 2001, "z", "z"), (999, 2001, "new", "z")], SCHEMA)
    table.insert_if_absent(added)
    grown = table.files()
    assert grown["y=2001"] > after["y=2001"] and all(grown[p] == after[p] for p in after if p != "y=2001")
    assert rows_of(table.read().where("k in (1, 999) and y = 2001")) == [(1, 2001, "a", "x"), (999, 2001, "new", "z")]


def test_touched_partitions_are_pruned_at_the_scan(spark):
    first = spark.createDataFrame([(i, 2000 + i % 5, "a", "x") for i in range(50)], SCHEMA)
    table = StoredTable(spark, "t", first.schema, ["k", "y"], partition_by="y")
    table.upsert(first)
    plan = table.read(partitions=[2003])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2003" in re.search(r"PartitionFilters: \[(.*?)\]", plan)[1]


def test_update_from(spark):
    first = spark.createDataFrame([(i, 2000 + i % 5, "a", "x") for i in range(50)], SCHEMA)
    table = StoredTable(spark, "t", first.schema, ["k", "y"], partition_by="y")
    table.upsert(first)
    before = table.files()
    values = spark.createDataFrame([(3, "new"), (8, None), (1000, "nobody")], "k long, v string")
    assert table.update_from(values, ["k"], ["v"]) == [2003]
    want = [(i, 2000 + i % 5, {3: "new", 8: None}.get(i, "a"), "x") for i in range(50)]
    assert rows_of(table.read()) == sorted(want, key=repr)
    assert {p for p, f in table.files().items() if f != before[p]} == {"y=2003"}


def test_a_key_may_not_leave_its_partition(spark):
    with pytest.raises(ValueError):
        StoredTable(spark, "t", spark.createDataFrame([], SCHEMA).schema, ["k"], partition_by="y")


def test_infrastructure_types_are_upserted(spark):
    """M-F0a: names and flags of known types change, new ones are added, what
    is archived later stays as it was."""
    categories = spark.createDataFrame([(1, "Rooms")], "id long, name string")
    flags = spark.createDataFrame([(1, False, None), (2, True, True)], "id long, is_lab_yn boolean, is_sanitation_yn boolean")
    types = "id long, name string, item_category_id long, is_active_yn boolean, is_archived_yn boolean, is_deleted boolean"
    runs = [[(1, "Class", 1, None, False, None), (2, "Lab", 9, True, False, False)],
            [(1, "Classroom", 1, False, False, None), (2, "Laboratory", 1, True, True, False), (3, "Hall", None, True, False, False)]]
    table = None
    for rows in runs:
        batch = IN.type_dim_rows(spark.createDataFrame(rows, types), categories, flags)
        table = table or StoredTable(spark, "types", batch.schema, ["source_id"], parts=1)
        table.upsert(batch, IN.TYPE_UPDATE_COLS)
    got = {r["source_id"]: (r["type_name"], r["item_category"], r["is_lab_yn"], r["is_sanitation_yn"], r["is_active_yn"]) for r in table.read().collect()}
    assert got == {1: ("Classroom", "Rooms", False, False, False), 2: ("Lab", None, True, True, True), 3: ("Hall", None, False, False, True)}


# --- stored dimensions -----------------------------------------------------------

def snapshots(spark):
    schema = "id long, name string, size int"
    days = [[(i, f"n{i}", i % 3) for i in range(40)],
            [(i, f"n{i}" if i % 4 else f"m{i}", i % 3) for i in range(5, 45)],
            [(i, f"n{i}" if i % 4 else f"m{i}", None if i % 5 == 0 else i % 3) for i in range(45)]]
    return [spark.createDataFrame(d, schema) for d in days]


def test_stored_dimension_equals_the_rebuilt_one(spark):
    days = ["2020-01-01", "2020-02-01", "2020-03-01"]
    dim, plain = None, None
    for snap, day in zip(snapshots(spark), days):
        dim = dim or StoredDimension(spark, "d", snap, ["id"], ["name", "size"])
        plain = plain if plain is not None else empty_dim(spark, snap, ["id", "name", "size"])
        plain = spark.createDataFrame(scd2_merge(plain, snap, ["id"], ["name", "size"], day).collect(), dim.schema)
        dim.merge(snap, day)
        assert rows_of(dim.read()) == rows_of(plain)
    dim.merge(snapshots(spark)[-1], days[-1])
    assert rows_of(dim.read()) == rows_of(plain)


def test_a_second_run_of_a_day_keeps_what_the_first_closed(spark):
    a, b, c = snapshots(spark)
    dim = StoredDimension(spark, "d", a, ["id"], ["name", "size"])
    dim.merge(a, "2020-01-01")
    dim.merge(b, "2020-02-01")
    closed = dim.read().where("not is_current").count()
    dim.merge(c, "2020-02-01")
    history = dim.read().where("not is_current")
    assert history.count() > closed and {r[0] for r in history.select("expiration_date").collect()} == {datetime.date(2020, 1, 31)}
    assert dim.read().groupBy("id").agg(F.sum(F.col("is_current").cast("int")).alias("n")).where("n <> 1").count() == 0


def test_a_merge_does_not_move_the_dimension(spark):
    """Only the snapshot is exchanged; only the current partition is read."""
    a, b, _ = snapshots(spark)
    dim = StoredDimension(spark, "d", a, ["id"], ["name", "size"])
    dim.merge(a, "2020-01-01")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = dim.plan(b, "2020-02-01")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # scd2_merge unites the join with the (empty) history of what it is given.
    joined = plan[plan.index("SortMergeJoin"):]
    assert joined.count("Exchange hashpartitioning") == 1
    scan = joined.index("FileScan parquet")
    exchange = joined.index("Exchange hashpartitioning")
    branch = lambda at: len(re.match(r"[\s:|+\-*()\d]*", joined[joined.rindex("\n", 0, at) + 1:])[0])
    assert scan < exchange or branch(scan) < branch(exchange) or "Scan ExistingRDD" in joined[exchange:]
    assert "is_current#" in re.search(r"PartitionFilters: \[(.*?)\]", joined)[1] and "Bucketed: true" in joined


# --- hierarchies -----------------------------------------------------------------

def test_climb_any_depth(spark):
    chain = [(i, i - 1 if i else None, "top" if i in (0, 40) else "x") for i in range(100)]
    odd = [(200, 201, "x"), (201, 202, "x"), (202, 200, "top"), (203, 202, "x"), (300, 999, "top"), (301, 300, "x"), (302, 301, "x"), (400, 400, "x"),
           (None, 1, "x")]
    nodes = spark.createDataFrame(chain + odd, "id long, parent long, kind string")
    got = {r["id"]: tuple(r)[1:] for r in tree.climb(nodes, "id", "parent", "kind", ("top",)).collect()}
    assert all(got[i] == (0, i, "OK", 40 if i >= 40 else 0) for i in range(100))
    assert all(got[i][:3] == (None, None, "CYCLE") for i in (200, 201, 202, 203, 400))
    assert [got[i] for i in (300, 301, 302)] == [(300, d, "ORPHAN", 300) for d in range(3)]
    assert len(got) == 108


def test_climb_an_empty_table(spark):
    assert tree.climb(spark.createDataFrame([], "id long, parent long"), "id", "parent").collect() == []


# --- distinct counts that roll up --------------------------------------------------

def test_bitmaps_roll_up(spark):
    rows = [(i % 7, i % 3, (i * 7919) % 50_000) for i in range(5_000)] + [(0, 0, None), (8, None, None)]
    df = spark.createDataFrame(rows, "school long, kind long, person long")
    bits = coverage.bitmaps(df, ["school", "kind"], "person")
    counts = {"n": None, "ones": F.col("kind") == 1}
    for groups in (["school"], []):
        want = df.where("person is not null").groupBy(*groups).agg(F.countDistinct("person").alias("n"),
                                                                     F.countDistinct(F.when(F.col("kind") == 1, F.col("person"))).alias("ones"))
        assert rows_of(coverage.distinct_counts(bits, groups, counts)) == rows_of(want)
    assert rows_of(coverage.distinct_counts(coverage.merged(bits, ["school"]), ["school"], {"n": None})) == \
        rows_of(df.where("person is not null").groupBy("school").agg(F.countDistinct("person").alias("n")))


# --- writes that account for their rows --------------------------------------------

def test_steps_are_counted_while_written(spark):
    stored, log = errors.run_steps(spark, "r", [("a", spark.range(10)), ("b", lambda done: done["a"].where("id % 2 = 0")), ("c", spark.range(0))])
    assert [(r["step_no"], r["step_name"], r["rows_written"]) for r in log.orderBy("step_no").collect()] == [(1, "a", 10), (2, "b", 5), (3, "c", 0)]
    assert stored["b"].count() == 5


def test_error_rows(spark):
    root = f"{checkpoint_dir(spark)}/errors-{uuid.uuid4().hex}"
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    rows = spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":2',), (None,), ('{"b":"no a"}',), ('{"a":"word"}',), ("",)], "j string")
    good, bad, counts = errors.split_write(rows, "j", schema, "src", "r1", root, ["a"])
    assert rows_of(good) == [(1, "x")] and counts == {"rows_read": 6, "rows_failed": 5}
    assert rows_of(bad.select("raw_data", "reason")) == sorted(
        [('{"a":2', "NOT_DECODABLE"), (None, "NOT_DECODABLE"), ('{"b":"no a"}', "MISSING_A"), ('{"a":"word"}', "NOT_DECODABLE"), ("", "NOT_DECODABLE")], key=repr)
    errors.split_write(rows.limit(2), "j", schema, "src", "r2", root)
    errors.split_write(rows.limit(2), "j", schema, "src", "r2", root)
    assert {(r[0], r[1]) for r in errors.read_errors(spark, root).groupBy("run_id").count().collect()} == {("r1", 5), ("r2", 1)}


def test_stream_of_newest_rows(spark):
    root = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    day = lambda d: datetime.datetime(2020, 1, d)
    put = lambda n, rows: spark.createDataFrame(rows, schema).write.parquet(f"{root}/in/{n}")
    put(1, [(1, day(3)), (1, day(1)), (2, day(2))])
    assert rows_of(run_latest(spark, f"{root}/in", schema, "k", "ts", root)) == [(1, day(3), 2), (2, day(2), 1)]
    put(2, [(1, day(2)), (2, day(9)), (3, day(1))])
    want = [(1, day(3), 3), (2, day(9), 2), (3, day(1), 1)]
    for _ in range(2):
        assert rows_of(run_latest(spark, f"{root}/in", schema, "k", "ts", root)) == want
    assert latest_watermark(spark, root).collect()[0][0] == day(9)


# --- copies, versions, schemas -----------------------------------------------------

def test_copy_resumes_where_it_stopped(spark):
    target = f"{checkpoint_dir(spark)}/copy-{uuid.uuid4().hex}"
    source = spark.createDataFrame([(5 if i < 400 else i, f"v{i}") for i in range(1000)] + [(None, "null"), (-3, "low")], "k long, v string")
    left = copy.copy_in_chunks(source, "k", target, chunks=10, at_most=2)
    first = {tuple(r) for r in copy.ledger(spark, target).collect()}
    assert len(first) == 2 and left > 2 and copy.copied(spark, source, target).count() < 1002
    assert copy.copy_in_chunks(source, "k", target, chunks=3) == 0          # the plan of the first run holds
    assert first < {tuple(r) for r in copy.ledger(spark, target).collect()}
    assert rows_of(copy.copied(spark, source, target)) == rows_of(source)
    assert copy.copy_in_chunks(source, "k", target) == 0
    empty = spark.createDataFrame([], source.schema)
    assert copy.copy_in_chunks(empty, "k", f"{target}-none", chunks=4) == 0 and copy.copied(spark, empty, f"{target}-none").count() == 0


def test_versions(spark):
    root = f"{checkpoint_dir(spark)}/versions-{uuid.uuid4().hex}"
    with pytest.raises(FileNotFoundError):
        versions.newest(spark, root, "t")
    for n in range(1, 5):
        versions.reload(spark.range(n), root, "t")
    # A version whose write was cut off has no success marker.
    unfinished = versions.reload(spark.range(100), root, "t")
    fs, marker = versions._fs(spark, f"{unfinished}/_SUCCESS")
    fs.delete(marker, False)
    assert versions.newest(spark, root, "t").count() == 4
    versions.reload(versions.newest(spark, root, "t").union(spark.range(1)), root, "t")     # reads the version before
    assert versions.newest(spark, root, "t").count() == 5
    assert unfinished in versions.prune(spark, root, "t", keep=2)
    assert [c for _, c in versions.versions(spark, root, "t")] == [True, True] and versions.newest(spark, root, "t").count() == 5


def test_schema_changes(spark):
    of = lambda text: spark.createDataFrame([], text).schema
    old, new = of("a int, b string, c date, d double"), of("a bigint, b int, c date, e string")
    assert versions.schema_changes(old, new) == [("a", "WIDENED", "int", "bigint"), ("b", "CHANGED", "string", "int"), ("d", "REMOVED", "double", None),
                                                 ("e", "ADDED", None, "string")]
    assert versions.discovered(spark, old, new).count() == 4
    rows = spark.createDataFrame([(1, "x")], "a int, b string")
    assert versions.aligned(rows, of("b string, a bigint, z date")).collect() == [("x", 1, None)]
    with pytest.raises(ValueError):
        versions.aligned(rows, of("a int, b int"))

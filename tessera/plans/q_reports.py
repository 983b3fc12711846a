"""Aggregates, set operations, extracts, transfers, reports and audit logs."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import rules
from tessera.operators.asof import latest_before
from tessera.operators.dedupe import pick_one
from tessera.operators.hierarchy import unit_to_district
from tessera.session import checkpoint_dir
from tessera.sources import extract as X
from tessera.plans import views as V
from tessera.plans.q_relational import HIERARCHY_BODY, units
from tessera.plans.q_warehouse import customer_dim
from tessera.plans.registry import Tables, query

# --- aggregates ---------------------------------------------------------------


@query("grouped_counts", sql="""SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS order_year,
  count(*) AS orders, count(o_custkey) AS with_customer
FROM orders GROUP BY o_orderstatus, year(o_orderdate)""")
def q_grouped_counts(spark, base):
    """AGG-01: COUNT(*) / COUNT(col) per group."""
    o = Tables(spark, base).orders
    return o.groupBy("o_orderstatus", F.year("o_orderdate").alias("order_year")).agg(
        F.count(F.lit(1)).alias("orders"), F.count("o_custkey").alias("with_customer"))


@query("filtered_counts", sql="""SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year,
  count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
  count(CASE WHEN l_discount >= 0.05 THEN 1 END) AS discounted,
  count(*) FILTER (WHERE l_linestatus = 'F' AND l_quantity > 25) AS big_finished
FROM lineitem GROUP BY year(l_shipdate)""")
def q_filtered_counts(spark, base):
    """AGG-02 / AGG-03: COUNT(*) FILTER and COUNT(CASE ..)."""
    li = Tables(spark, base).lineitem
    return li.groupBy(F.year("l_shipdate").alias("ship_year")).agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count(F.when(F.col("l_discount") >= 0.05, 1)).alias("discounted"),
        F.count_if((F.col("l_linestatus") == "F") & (F.col("l_quantity") > 25)).alias("big_finished"))


@query("duplicate_keys", sql="""SELECT p_name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1""")
def q_duplicate_keys(spark, base):
    """AGG-07: keys occurring more than once."""
    return Tables(spark, base).part.groupBy("p_name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("distinct_levels", sql="""SELECT p_brand, count(DISTINCT p_type) AS types FROM part GROUP BY p_brand""")
def q_distinct_levels(spark, base):
    """AGG-09: COUNT(DISTINCT)."""
    return Tables(spark, base).part.groupBy("p_brand").agg(F.count_distinct("p_type").alias("types"))


@query("summary_counts", sql="""SELECT count(*) AS orders, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
  (SELECT count(*) FROM lineitem) AS lineitems,
  (SELECT max(p_retailprice) FROM part) AS top_price
FROM orders""")
def q_summary_counts(spark, base):
    """AGG-10 / AGG-11: global count/min/max plus uncorrelated scalar
    subqueries, gathered as one-row aggregates combined by union + max."""
    t = Tables(spark, base)
    none_l, none_t, none_d = F.lit(None).cast("long"), F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("double")
    a = t.orders.agg(F.count(F.lit(1)).alias("orders"), F.min("o_orderdate").alias("first_order"),
                     F.max("o_orderdate").alias("last_order")) \
        .select("orders", "first_order", "last_order", none_l.alias("lineitems"), none_d.alias("top_price"))
    b = t.lineitem.agg(F.count(F.lit(1)).alias("lineitems")) \
        .select(none_l.alias("orders"), none_t.alias("first_order"), none_t.alias("last_order"), "lineitems",
                none_d.alias("top_price"))
    c = t.part.agg(F.max("p_retailprice").alias("top_price")) \
        .select(none_l.alias("orders"), none_t.alias("first_order"), none_t.alias("last_order"),
                none_l.alias("lineitems"), "top_price")
    u = a.unionByName(b).unionByName(c)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


@query("distinct_rows", sql="SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def q_distinct_rows(spark, base):
    """AGG-12."""
    return Tables(spark, base).orders.select("o_orderstatus", "o_orderpriority").distinct()


@query("top_n", sql="""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q_top_n(spark, base):
    """LIM-02 / SRT-01: top 10 (the limit is the feature; ties broken by key)."""
    return Tables(spark, base).orders.select("o_orderkey", "o_totalprice") \
        .orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query("top1_per_group", sql="""SELECT o_orderpriority, arg_max(o_orderkey, o_orderdate) AS latest_order,
  max(o_orderdate) AS latest_date
FROM (SELECT o_orderpriority, o_orderkey, o_orderdate FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_orderdate ORDER BY o_orderkey DESC) = 1) x
GROUP BY o_orderpriority""")
def q_top1_per_group(spark, base):
    """LIM-01: ORDER BY date DESC LIMIT 1 per group as max_by (ties: largest key)."""
    o = Tables(spark, base).orders
    best = pick_one(o, ["o_orderpriority"], [("o_orderdate", "desc"), ("o_orderkey", "desc")],
                    ["o_orderkey", "o_orderdate"])
    return best.select("o_orderpriority", F.col("o_orderkey").alias("latest_order"),
                       F.col("o_orderdate").alias("latest_date"))


@query("semi_join", sql="""SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def q_semi_join(spark, base):
    """J-10: IN (subquery) as a left semi join."""
    t = Tables(spark, base)
    big = t.orders.where(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(big, "c_custkey", "left_semi")


@query("filtered_left_join", sql="""SELECT o.o_orderkey, count(l.l_orderkey) AS returned_lines
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R'
GROUP BY o.o_orderkey""")
def q_filtered_left_join(spark, base):
    """J-17: a filter inside a LEFT JOIN's ON applies to the right side only."""
    t = Tables(spark, base)
    r = t.lineitem.where(F.col("l_returnflag") == "R").groupBy("l_orderkey") \
        .agg(F.count(F.lit(1)).alias("returned_lines"))
    return t.orders.select("o_orderkey").join(r, F.col("o_orderkey") == F.col("l_orderkey"), "left") \
        .select("o_orderkey", F.coalesce("returned_lines", F.lit(0)).alias("returned_lines"))


@query("count_union", sql="""SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'part', count(*) FROM part""")
def q_count_union(spark, base):
    """SET-03: UNION ALL of table counts."""
    t = Tables(spark, base)
    parts = [getattr(t, n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n in ["orders", "lineitem", "customer", "part"]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("subject_dim_union", sql="""SELECT p_partkey AS source_id, 'PRIMARY' AS subject_level, p_name AS name,
  CASE WHEN p_type = 'SMALL' THEN 'LANGUAGE' WHEN p_size > 25 THEN 'SCIENCE' ELSE 'ARTS' END AS subject_category
FROM part WHERE p_size <= 30
UNION ALL
SELECT p_partkey, 'SECONDARY', upper(p_name),
  CASE WHEN p_brand LIKE '%1' THEN 'LANGUAGE' WHEN p_retailprice > 1500 THEN 'SCIENCE' ELSE 'ARTS' END
FROM part WHERE p_size > 20""")
def q_subject_dim_union(spark, base):
    """M-U0a / M-U1a / D-17: two subject levels sharing ids, keyed by
    (source_id, level) so neither level drops the other's rows."""
    p = Tables(spark, base).part
    a = p.where(F.col("p_size") <= 30).select(
        F.col("p_partkey").alias("source_id"), F.lit("PRIMARY").alias("subject_level"), F.col("p_name").alias("name"),
        rules.subject_category(F.col("p_type") == "SMALL", F.col("p_size") > 25).alias("subject_category"))
    b = p.where(F.col("p_size") > 20).select(
        "p_partkey", F.lit("SECONDARY"), F.upper("p_name"),
        rules.subject_category(F.col("p_brand").like("%1"), F.col("p_retailprice") > 1500))
    return a.union(b)


# --- extracts -----------------------------------------------------------------

@query("extract_projection", sql="""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderstatus = 'F'""")
def q_extract_projection(spark, base):
    """SRC-01/02: explicit projection; the filter and the 4 columns reach the scan."""
    return X.extract_projection(Tables(spark, base).orders, ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
                                where=F.col("o_orderstatus") == "F")


@query("extract_json", sql="""SELECT s_suppkey, to_json(struct_pack(s_suppkey := s_suppkey, s_name := s_name,
  s_nationkey := s_nationkey, s_phone := CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'P-' || CAST(s_suppkey AS VARCHAR) END))
  AS row_json FROM supplier""")
def q_extract_json(spark, base):
    """SRC-03 / JSN-01: each row as JSON with NULL fields kept."""
    s = Tables(spark, base).supplier.select(
        "s_suppkey", "s_name", "s_nationkey",
        F.when(F.col("s_suppkey") % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("P-"), F.col("s_suppkey").cast("string"))).alias("s_phone"))
    return X.rows_as_json(s, key="s_suppkey")


_SUPP_SCHEMA = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                             T.StructField("s_nationkey", T.IntegerType())])


@query("extract_json_errors", sql="""SELECT count(*) FILTER (WHERE NOT coalesce(json_valid(j), FALSE)) AS bad_rows,
  count(*) FILTER (WHERE coalesce(json_valid(j), FALSE)) AS good_rows
FROM (SELECT CASE WHEN s_suppkey % 17 = 0 THEN substr(j0, 1, 12) ELSE j0 END AS j
      FROM (SELECT s_suppkey, CAST(to_json(struct_pack(s_suppkey := s_suppkey, s_name := s_name,
              s_nationkey := s_nationkey)) AS VARCHAR) AS j0 FROM supplier) y) x""")
def q_extract_json_errors(spark, base):
    """SRC-03 / AUD-5: undecodable rows are separated and counted."""
    s = Tables(spark, base).supplier.select("s_suppkey", "s_name", "s_nationkey")
    j = X.rows_as_json(s, key="s_suppkey").select(
        F.when(F.col("s_suppkey") % 17 == 0, F.substring("row_json", 1, 12)).otherwise(F.col("row_json"))
        .alias("row_json"))
    good, bad = X.parse_json_rows(j, "row_json", _SUPP_SCHEMA)
    none = F.lit(None).cast("long")
    u = bad.agg(F.count(F.lit(1)).alias("bad_rows")).select("bad_rows", none.alias("good_rows")) \
        .unionByName(good.agg(F.count(F.lit(1)).alias("good_rows")).select(none.alias("bad_rows"), "good_rows"))
    return u.agg(F.max("bad_rows").alias("bad_rows"), F.max("good_rows").alias("good_rows"))


@query("extract_incremental", sql="""SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""")
def q_extract_incremental(spark, base):
    """SRC-11: rows at/after the stored watermark."""
    rows, _ = X.incremental_extract(Tables(spark, base).orders.select("o_orderkey", "o_orderdate"),
                                    "o_orderdate", "2000-01-01 00:00:00")
    return rows


@query("extract_watermark", sql="""SELECT coalesce(max(o_orderdate), TIMESTAMP '2000-01-01') AS next_watermark,
  count(*) AS rows_extracted FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""")
def q_extract_watermark(spark, base):
    """SRC-11 / AUD-6: the next watermark and the extracted count."""
    _, nxt = X.incremental_extract(Tables(spark, base).orders, "o_orderdate", "2000-01-01 00:00:00")
    return nxt


_CSV_SCHEMA = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                            T.StructField("s_acctbal", T.DoubleType())])


@query("csv_roundtrip", sql="""SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_name END AS s_name, s_acctbal
FROM supplier""")
def q_csv_roundtrip(spark, base):
    """SRC-10 / SNK-01: headerless CSV with empty = NULL, written to a fresh
    version folder under the shared checkpoint folder, then read back."""
    s = Tables(spark, base).supplier.select(
        "s_suppkey", F.when(F.col("s_suppkey") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("s_name"))
        .alias("s_name"), "s_acctbal")
    path = X.new_version_path(os.path.join(checkpoint_dir(spark), "csv"), f"supplier-{uuid.uuid4().hex[:6]}")
    X.write_csv(s, path)
    return X.read_csv(spark, path, _CSV_SCHEMA)


# --- transfers (role-playing dims, latest-before posting) ------------------------

def transfers(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                           F.to_date("l_shipdate").alias("posting_date"))
    # Incoming school: the supplier on the order's first line (one row per order).
    first_line = V.first_supplier(li, "__o", "incoming_school")
    x = li.join(first_line, F.col("l_orderkey") == F.col("__o"), "left").drop("__o")
    supp = t.supplier.select("s_suppkey", "s_nationkey")
    out_s = supp.select(F.col("s_suppkey").alias("__os"), F.col("s_nationkey").alias("out_nation"))
    in_s = supp.select(F.col("s_suppkey").alias("__is"), F.col("s_nationkey").alias("in_nation"))
    x = (x.join(out_s, F.col("l_suppkey") == F.col("__os"), "left")
          .join(in_s, F.col("incoming_school") == F.col("__is"), "left").drop("__os", "__is"))
    code = (F.col("l_linenumber") % 4).cast("int")
    x = x.select("*", code.alias("status"),
                 F.date_add("posting_date", (F.col("l_linenumber") * 3 - 4).cast("int")).alias("reporting_date"))
    postings = li.where((F.col("l_linenumber") % 4).isin(1, 2)) \
        .select(F.col("l_partkey").alias("p_person"), F.col("l_suppkey").alias("p_school"),
                F.col("posting_date").alias("p_date"))
    x = latest_before(x, postings, ["l_partkey", "l_suppkey"], ["p_person", "p_school"], "posting_date", "p_date",
                      kind="date", out_time="prev_posting")
    return x.select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("person_id"),
        F.col("l_suppkey").alias("outgoing_school"), "incoming_school", "out_nation", "in_nation",
        rules.code_map("status", rules.TRANSFER_STATUS, rules.TRANSFER_STATUS_ELSE).alias("transfer_status"),
        rules.inter_district("out_nation", "in_nation").alias("is_inter_district"),
        F.datediff("reporting_date", "posting_date").alias("days_to_report"),
        F.datediff("posting_date", "prev_posting").alias("days_at_outgoing_station"))


TRANSFERS_SQL = """li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS posting_date FROM lineitem),
post AS (SELECT l_partkey AS p_person, l_suppkey AS p_school, posting_date AS p_date FROM li WHERE l_linenumber % 4 IN (1, 2)),
base AS (
  SELECT li.*, f.l_suppkey AS incoming_school, so.s_nationkey AS out_nation, si.s_nationkey AS in_nation,
         CAST(li.l_linenumber % 4 AS INTEGER) AS status, CAST(li.posting_date + (li.l_linenumber * 3 - 4) AS DATE) AS reporting_date
  FROM li LEFT JOIN (SELECT l_orderkey, first(l_suppkey ORDER BY l_linenumber, l_suppkey) AS l_suppkey
                     FROM li GROUP BY l_orderkey) f ON f.l_orderkey = li.l_orderkey
  LEFT JOIN supplier so ON so.s_suppkey = li.l_suppkey LEFT JOIN supplier si ON si.s_suppkey = f.l_suppkey),
tr AS (
  SELECT b.l_orderkey, b.l_linenumber, b.l_partkey AS person_id, b.l_suppkey AS outgoing_school, b.incoming_school,
         b.out_nation, b.in_nation,
         CASE b.status WHEN 1 THEN 'PENDING' WHEN 2 THEN 'APPROVED' WHEN 3 THEN 'REJECTED' ELSE 'UNKNOWN' END AS transfer_status,
         CASE WHEN b.out_nation IS NOT NULL AND b.in_nation IS NOT NULL AND b.out_nation <> b.in_nation THEN TRUE ELSE FALSE END AS is_inter_district,
         CAST(date_diff('day', b.posting_date, b.reporting_date) AS INTEGER) AS days_to_report,
         CAST(date_diff('day', p.p_date, b.posting_date) AS INTEGER) AS days_at_outgoing_station
  FROM base b ASOF LEFT JOIN post p ON p.p_person = b.l_partkey AND p.p_school = b.l_suppkey AND b.posting_date > p.p_date)"""


@query("transfer_roles", sql=f"WITH {TRANSFERS_SQL}\nSELECT * FROM tr")
def q_transfer_roles(spark, base):
    """M-X0 / J-18 / J-07 / D-11f / D-13 / D-14 / D-15: one supplier table in
    two roles, days since the latest earlier posting at the outgoing school."""
    return transfers(Tables(spark, base))


@query("report_flow", sql=f"""WITH {TRANSFERS_SQL}
SELECT out_nation, in_nation, count(*) AS transfers, count(*) FILTER (WHERE is_inter_district) AS inter_district,
       CAST(round(avg(days_at_outgoing_station), 2) AS DOUBLE) AS avg_days_at_station
FROM tr WHERE transfer_status = 'APPROVED' GROUP BY out_nation, in_nation""")
def q_report_flow(spark, base):
    """RPT-8: approved district-to-district flow and time at station."""
    tr = transfers(Tables(spark, base)).where(F.col("transfer_status") == "APPROVED")
    return tr.groupBy("out_nation", "in_nation").agg(
        F.count(F.lit(1)).alias("transfers"), F.count_if("is_inter_district").alias("inter_district"),
        F.round(F.avg("days_at_outgoing_station"), 2).alias("avg_days_at_station"))


# --- reports over the customer dimension -----------------------------------------

@query("report_history", sql=f"""WITH {V.customer_dim_sql(3)}
SELECT c_custkey, effective_date, expiration_date, change_reason,
       row_number() OVER (PARTITION BY c_custkey ORDER BY effective_date) AS version_no,
       count(*) OVER (PARTITION BY c_custkey) AS versions
FROM dim3""")
def q_report_history(spark, base):
    """RPT-4 / SCD-05: every key's versions numbered in time order (a key's
    version count is bounded by the number of loads)."""
    dim = customer_dim(spark, base, 3)
    w = Window.partitionBy("c_custkey").orderBy("effective_date")
    return dim.select("c_custkey", "effective_date", "expiration_date", "change_reason",
                      F.row_number().over(w).alias("version_no"),
                      F.count(F.lit(1)).over(Window.partitionBy("c_custkey")).alias("versions"))


@query("report_changed_field", sql=f"""WITH {V.customer_dim_sql(3)}
SELECT c_custkey, c_name, effective_date, changed_fields FROM dim3 WHERE changed_fields LIKE '%c_name%'""")
def q_report_changed_field(spark, base):
    """RPT-7: versions whose change list names a field."""
    dim = customer_dim(spark, base, 3)
    return dim.where(F.col("changed_fields").like("%c_name%")).select("c_custkey", "c_name", "effective_date",
                                                                      "changed_fields")


@query("report_status_by_date", sql=f"""WITH {V.customer_dim_sql(3)}
SELECT d.c_mktsegment, count(*) AS customers
FROM dim3 d WHERE DATE '1998-06-30' BETWEEN d.effective_date AND d.expiration_date
GROUP BY d.c_mktsegment""")
def q_report_status_by_date(spark, base):
    """RPT-5: dimension members by status as valid on a date (as-of filter)."""
    dim = customer_dim(spark, base, 3)
    day = F.to_date(F.lit("1998-06-30"))
    return dim.where((F.col("effective_date") <= day) & (F.col("expiration_date") >= day)) \
        .groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@query("report_region_mix", sql=f"""WITH {V.customer_dim_sql(3)}, {V.ADMIN_UNITS_SQL.strip()},
u2d AS ({HIERARCHY_BODY})
SELECT u.district_name, d.c_mktsegment, count(*) AS customers
FROM dim3 d JOIN u2d u ON u.unit_dim_id = (CAST(d.c_nationkey AS BIGINT) * 10 + {V.UNIT_CODE['County']}) * 2
WHERE d.is_current GROUP BY u.district_name, d.c_mktsegment""")
def q_report_region_mix(spark, base):
    """RPT-6: current members by District (through the hierarchy) x segment."""
    t = Tables(spark, base)
    dim = customer_dim(spark, base, 3).where("is_current")
    u2d = unit_to_district(units(t))
    d = dim.withColumn("unit_dim_id", (F.col("c_nationkey").cast("long") * 10 + V.UNIT_CODE["County"]) * 2)
    return d.join(u2d, "unit_dim_id").groupBy("district_name", "c_mktsegment") \
        .agg(F.count(F.lit(1)).alias("customers"))


@query("report_coverage_gap", sql="""SELECT l_suppkey AS school, p.subject_type
FROM (SELECT DISTINCT l_suppkey FROM lineitem) s
CROSS JOIN (SELECT DISTINCT p_type || '/' || p_brand AS subject_type FROM part) p
WHERE NOT EXISTS (SELECT 1 FROM lineitem l JOIN part q ON q.p_partkey = l.l_partkey
                  WHERE l.l_suppkey = s.l_suppkey AND q.p_type || '/' || q.p_brand = p.subject_type)""")
def q_report_coverage_gap(spark, base):
    """RPT-9: required (school x subject type) pairs nobody covers. Each
    school's offered types are gathered into a set (types are a code list) and
    taken from the list of all types; only the gaps become rows."""
    t = Tables(spark, base)
    subject = F.concat_ws("/", "p_type", "p_brand")
    types = t.part.select(subject.alias("subject_type")).distinct().agg(F.collect_list("subject_type")).scalar()
    offered = t.lineitem.select("l_suppkey", "l_partkey") \
        .join(t.part.select(F.col("p_partkey").alias("l_partkey"), subject.alias("subject_type")), "l_partkey", "left") \
        .groupBy(F.col("l_suppkey").alias("school"), "subject_type").agg(F.count(F.lit(1)).alias("n"))
    return offered.groupBy("school").agg(F.collect_list("subject_type").alias("offered")) \
        .select("school", F.explode(F.array_except(types, F.col("offered"))).alias("subject_type"))


# --- audit: run / step logs of the three customer-dimension runs -------------------

def _run_events(spark, base):
    """One RUNNING and one SUCCESS event per business date; counts come from
    the day's snapshot and the versions the merge opened that day."""
    from tessera.operators import audit as A
    from tessera.plans.q_warehouse import customer_dim
    t = Tables(spark, base)
    dim = customer_dim(spark, base, 3)
    snaps = [V.customer_day1(t.customer), V.customer_day2(t.customer), V.customer_day3(t.customer)]
    events, steps = None, None
    for i, (snap, day) in enumerate(zip(snaps, [V.DAY1, V.DAY2, V.DAY3]), start=1):
        raw_n = snap.agg(F.count(F.lit(1)).alias("raw_rows"))
        new_n = dim.where(F.col("effective_date") == F.to_date(F.lit(day))) \
            .agg(F.count(F.lit(1)).alias("new_versions"))
        none = F.lit(None).cast("long")
        c = raw_n.select("raw_rows", none.alias("new_versions")) \
            .unionByName(new_n.select(none.alias("raw_rows"), "new_versions")) \
            .agg(F.max("raw_rows").alias("raw_rows"), F.max("new_versions").alias("new_versions"))
        start = F.lit(f"{day} 01:00:00").cast("timestamp_ntz")
        end = start + F.make_dt_interval(mins=(F.col("raw_rows") / 100).cast("int"))
        rid, aso = F.lit(i).cast("long"), F.to_date(F.lit(day))
        ev = c.select(*A.run_event(rid, aso, "RUNNING", start)).unionByName(
            c.select(*A.run_event(rid, aso, "SUCCESS", end, F.struct("raw_rows", "new_versions"))))
        st = c.select(rid.alias("run_id"), F.explode(F.array(
            F.struct(F.lit("extract").alias("step"), F.col("raw_rows").alias("rows")),
            F.struct(F.lit("scd2").alias("step"), F.col("new_versions").alias("rows")))).alias("s"),
            start.alias("event_time")).select("run_id", "s.step", F.lit("SUCCESS").alias("status"), "s.rows",
                                             F.lit(None).cast("string").alias("message"), "event_time")
        events = ev if events is None else events.unionByName(ev)
        steps = st if steps is None else steps.unionByName(st)
    return events, steps


def _runs_sql() -> str:
    parts = []
    for i, day in enumerate([V.DAY1, V.DAY2, V.DAY3], start=1):
        parts.append(f"SELECT {i} AS run_id, DATE '{day}' AS as_of, (SELECT count(*) FROM snap{i}) AS raw_rows, "
                     f"(SELECT count(*) FROM dim3 WHERE effective_date = DATE '{day}') AS new_versions")
    return f"""WITH {V.customer_dim_sql(3)},
cnt AS ({' UNION ALL '.join(parts)}),
runs AS (SELECT CAST(run_id AS BIGINT) AS run_id, as_of, raw_rows, new_versions,
                CAST(as_of AS TIMESTAMP) + INTERVAL 1 HOUR AS started_at,
                CAST(as_of AS TIMESTAMP) + INTERVAL 1 HOUR + to_minutes(CAST(raw_rows // 100 AS BIGINT)) AS finished_at
         FROM cnt)"""


@query("audit_run_log", sql=_runs_sql() + """
SELECT run_id, as_of, 'SUCCESS' AS status, finished_at,
       CAST(to_json(struct_pack(raw_rows := raw_rows, new_versions := new_versions)) AS VARCHAR) AS counts_json,
       CAST(NULL AS VARCHAR) AS error, started_at
FROM runs""")
def q_audit_run_log(spark, base):
    """AUD-1 / AUD-2: append-only run events; current state = latest event."""
    from tessera.operators import audit as A
    events, _ = _run_events(spark, base)
    return A.runs_latest(events)


@query("report_runs", sql=_runs_sql() + """
SELECT run_id, as_of, 'SUCCESS' AS status, started_at, finished_at,
       round(date_diff('second', started_at, finished_at) / 60.0, 2) AS duration_minutes
FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 10""")
def q_report_runs(spark, base):
    """RPT-2: last 10 runs with duration in minutes (DAT-03)."""
    from tessera.operators import audit as A
    events, _ = _run_events(spark, base)
    return A.recent_runs(A.runs_latest(events), 10)


@query("audit_steps", sql=_runs_sql() + """
SELECT run_id, 'extract' AS step, 'SUCCESS' AS status, raw_rows AS rows, CAST(NULL AS VARCHAR) AS message,
       started_at AS event_time FROM runs
UNION ALL
SELECT run_id, 'scd2', 'SUCCESS', new_versions, CAST(NULL AS VARCHAR), started_at FROM runs""")
def q_audit_steps(spark, base):
    """AUD-3 / RPT-3: step log rows with row counts."""
    _, steps = _run_events(spark, base)
    return steps

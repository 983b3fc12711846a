"""Warehouse operators on the test tables: SCD2, as-of facts, keys, loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.operators import scd2
from tessera.operators.asof import asof_version, latest_before
from tessera.operators.calendar import date_dim, year_bounds
from tessera.operators.dedupe import pick_one
from tessera.operators.facts import load_fact_fallback, snapshot_fact, unresolved
from tessera.operators.keys import assign_surrogate
from tessera.operators.merge import insert_if_absent, upsert
from tessera.plans import views as V
from tessera.plans.registry import Tables, query
from tessera.session import materialize

DIM_COLS = V.CUSTOMER_KEY + V.CUSTOMER_TRACKED + scd2.CONTROL


def customer_dim(spark: SparkSession, base: str, days: int = 3, replay: bool = False) -> DataFrame:
    """Customer dimension after ``days`` nightly merges (day 1..3)."""
    t = Tables(spark, base)
    cust = t.customer
    snaps = [V.customer_day1(cust), V.customer_day2(cust), V.customer_day3(cust)]
    dates = [V.DAY1, V.DAY2, V.DAY3]
    dim = scd2.empty_dim(spark, snaps[0], V.CUSTOMER_KEY + V.CUSTOMER_TRACKED)
    for i in range(days):
        dim = scd2.scd2_merge(dim, snaps[i], V.CUSTOMER_KEY, V.CUSTOMER_TRACKED, dates[i],
                              reason_rules=V.CUSTOMER_RULES, initial_fields="ALL")
        if i < days - 1 or replay:  # a run's version is stored: the next merge reads it, not its history of merges
            dim = materialize(dim, f"customer_dim_{i + 1}")
    if replay:
        dim = scd2.scd2_merge(dim, snaps[days - 1], V.CUSTOMER_KEY, V.CUSTOMER_TRACKED,
                              dates[days - 1], reason_rules=V.CUSTOMER_RULES, initial_fields="ALL")
    return dim.select(*DIM_COLS)


def _dim_sql(days: int) -> str:
    return f"WITH {V.customer_dim_sql(days)}\nSELECT * FROM dim{days}"


@query("scd2_initial", sql=_dim_sql(1))
def q_scd2_initial(spark, base):
    return customer_dim(spark, base, 1)


@query("scd2_day2", sql=_dim_sql(2))
def q_scd2_day2(spark, base):
    return customer_dim(spark, base, 2)


@query("scd2_day3", sql=_dim_sql(3))
def q_scd2_day3(spark, base):
    return customer_dim(spark, base, 3)


@query("scd2_day3_replay", sql=_dim_sql(3))
def q_scd2_day3_replay(spark, base):
    """Replaying the same snapshot on the same date changes nothing."""
    return customer_dim(spark, base, 3, replay=True)


@query("scd2_stats", sql=f"""WITH {V.customer_dim_sql(3)}
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE is_current) AS current_rows,
       count(*) FILTER (WHERE NOT is_current) AS historical_rows
FROM dim3""")
def q_scd2_stats(spark, base):
    return scd2.scd2_stats(customer_dim(spark, base, 3))


@query("scd2_gaps", sql=f"""WITH {V.customer_dim_sql(3)},
planted AS (
  SELECT c_custkey, effective_date,
         CASE WHEN c_custkey % 19 = 0 AND effective_date = DATE '{V.DAY1}' THEN DATE '1996-06-30'
              ELSE expiration_date END AS expiration_date
  FROM dim3
),
nxt AS (
  SELECT c_custkey, effective_date, expiration_date,
         (SELECT min(b.effective_date) FROM planted b
           WHERE b.c_custkey = a.c_custkey AND b.effective_date > a.effective_date) AS next_effective_date
  FROM planted a
)
SELECT * FROM nxt
WHERE next_effective_date IS NOT NULL AND CAST(expiration_date + 1 AS DATE) <> next_effective_date""")
def q_scd2_gaps(spark, base):
    """Version-gap detection; every 19th key's first version is cut short to
    plant a gap the check must report."""
    dim = customer_dim(spark, base, 3)
    planted = dim.withColumn(
        "expiration_date",
        F.when((F.col("c_custkey") % 19 == 0) & (F.col("effective_date") == F.to_date(F.lit(V.DAY1))),
               F.to_date(F.lit("1996-06-30"))).otherwise(F.col("expiration_date")))
    # The planted row's successor depends on whether the key changed on day 2.
    return scd2.scd2_gaps(planted, V.CUSTOMER_KEY)


@query("scd2_history", sql=f"""WITH {V.customer_dim_sql(3)}
SELECT c_custkey, c_name, c_mktsegment, effective_date, expiration_date, change_reason, changed_fields
FROM dim3 WHERE changed_fields LIKE '%c_mktsegment%'""")
def q_scd2_history(spark, base):
    dim = customer_dim(spark, base, 3)
    return scd2.scd2_history(dim, changed_field="c_mktsegment").select(
        "c_custkey", "c_name", "c_mktsegment", "effective_date", "expiration_date",
        "change_reason", "changed_fields")


def _orders_dated(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                           F.to_date("o_orderdate").alias("order_date"))


@query("asof_join", sql=f"""WITH {V.customer_dim_sql(3)}
SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) AS order_date,
       d.c_mktsegment AS seg_c_mktsegment, d.effective_date AS seg_effective_date
FROM orders o LEFT JOIN dim3 d
  ON d.c_custkey = o.o_custkey AND CAST(o.o_orderdate AS DATE) >= d.effective_date
 AND CAST(o.o_orderdate AS DATE) <= d.expiration_date""")
def q_asof_join(spark, base):
    """J-05: the customer version valid on each order date (closed interval)."""
    t = Tables(spark, base)
    dim = customer_dim(spark, base, 3)
    o = _orders_dated(t).select("o_orderkey", "o_custkey", "order_date")
    return asof_version(o, dim, "o_custkey", "c_custkey", "order_date",
                        ["c_mktsegment", "effective_date"], "seg", closed=True)


@query("asof_boundary", sql=f"""WITH {V.customer_dim_sql(3)},
probe AS (
  SELECT c_custkey AS k, expiration_date AS probe_date FROM dim3 WHERE NOT is_current
)
SELECT p.k, p.probe_date,
       (SELECT d.effective_date FROM dim3 d WHERE d.c_custkey = p.k AND p.probe_date >= d.effective_date
         AND p.probe_date <= d.expiration_date) AS closed_version,
       (SELECT d.effective_date FROM dim3 d WHERE d.c_custkey = p.k AND p.probe_date >= d.effective_date
         AND p.probe_date < d.expiration_date) AS half_open_version
FROM probe p""")
def q_asof_boundary(spark, base):
    """D4: on a version's last day the closed test matches, half-open does not."""
    dim = customer_dim(spark, base, 3)
    probe = dim.where(~F.col("is_current")).select(F.col("c_custkey").alias("k"),
                                                    F.col("expiration_date").alias("probe_date"))
    a = asof_version(probe, dim, "k", "c_custkey", "probe_date", ["effective_date"], "cl", closed=True)
    b = asof_version(a, dim, "k", "c_custkey", "probe_date", ["effective_date"], "ho", closed=False)
    return b.select("k", "probe_date", F.col("cl_effective_date").alias("closed_version"),
                    F.col("ho_effective_date").alias("half_open_version"))


@query("orders_by_segment_fy", sql=f"""WITH {V.customer_dim_sql(3)},
f AS (
  SELECT o.o_totalprice, d.c_mktsegment,
         CAST(CASE WHEN month(o.o_orderdate) >= 7 THEN year(o.o_orderdate) + 1 ELSE year(o.o_orderdate) END AS INTEGER) AS fiscal_year
  FROM orders o JOIN dim3 d
    ON d.c_custkey = o.o_custkey AND CAST(o.o_orderdate AS DATE) BETWEEN d.effective_date AND d.expiration_date
)
SELECT c_mktsegment, fiscal_year, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue
FROM f GROUP BY c_mktsegment, fiscal_year""")
def q_orders_by_segment_fy(spark, base):
    """Flagship: orders by the customer segment valid on the order date, per fiscal year."""
    t = Tables(spark, base)
    dim = customer_dim(spark, base, 3)
    o = _orders_dated(t)
    f = asof_version(o, dim, "o_custkey", "c_custkey", "order_date", ["c_mktsegment"], "d",
                     closed=True, how="inner")
    return (f.groupBy(F.col("d_c_mktsegment").alias("c_mktsegment"),
                      rules.fiscal_year("order_date").alias("fiscal_year"))
             .agg(F.count(F.lit(1)).alias("orders"),
                  F.round(F.sum("o_totalprice"), 2).alias("revenue")))


@query("date_dim", sql="""WITH b AS (
  SELECT make_date(CAST(year(min(o_orderdate)) AS INTEGER), 1, 1) AS s,
         make_date(CAST(year(max(o_orderdate)) AS INTEGER), 12, 31) AS e FROM orders
), days AS (
  SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS system_date FROM b
)
SELECT system_date,
       CAST(day(system_date) AS INTEGER) AS day,
       CAST(month(system_date) AS INTEGER) AS month,
       rpad(monthname(system_date), 9, ' ') AS month_name,
       upper(strftime(system_date, '%b')) AS short_month,
       CAST(year(system_date) AS INTEGER) AS year,
       CAST(CASE WHEN month(system_date) >= 7 THEN year(system_date) + 1 ELSE year(system_date) END AS INTEGER) AS "FY",
       CASE WHEN month(system_date) IN (7,8,9) THEN 'Q1' WHEN month(system_date) IN (10,11,12) THEN 'Q2'
            WHEN month(system_date) IN (1,2,3) THEN 'Q3' ELSE 'Q4' END AS "Quarter"
FROM days""")
def q_date_dim(spark, base):
    """M-DATE over the whole years spanned by the order dates."""
    t = Tables(spark, base)
    return date_dim(year_bounds(t.orders, "o_orderdate"))


# ---------------------------------------------------------------------------
# A second SCD2 dimension (nation) so fact loads resolve two dims.
# ---------------------------------------------------------------------------
NATION_DAYS = ["1996-01-01", "1998-01-01"]


def nation_dim(spark, base):
    t = Tables(spark, base)
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    s1 = n
    s2 = n.select("n_nationkey",
                  F.when(F.col("n_nationkey") % 3 == 0, F.concat("n_name", F.lit("-X")))
                   .otherwise(F.col("n_name")).alias("n_name"), "n_regionkey")
    dim = scd2.empty_dim(spark, s1, ["n_nationkey", "n_name", "n_regionkey"])
    for snap, day in zip([s1, s2], NATION_DAYS):
        dim = materialize(scd2.scd2_merge(dim, snap, ["n_nationkey"], ["n_name", "n_regionkey"], day), "nation_dim")
    return dim


NATION_DIM_SQL = f"""
nsnap1 AS (SELECT n_nationkey, n_name, n_regionkey FROM nation),
nsnap2 AS (SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN n_name || '-X' ELSE n_name END AS n_name,
                  n_regionkey FROM nation),
{V.scd2_merge_sql(None, 'nsnap1', 'ndim1', NATION_DAYS[0], ['n_nationkey'], ['n_name', 'n_regionkey'], None, 'INITIAL_LOAD')},
{V.scd2_merge_sql('ndim1', 'nsnap2', 'ndim2', NATION_DAYS[1], ['n_nationkey'], ['n_name', 'n_regionkey'], None, 'INITIAL_LOAD')}"""


@query("scd2_second_dim", sql=f"WITH {NATION_DIM_SQL}\nSELECT * FROM ndim2")
def q_scd2_second_dim(spark, base):
    """SCD-01 without reason rules: every change is ATTRIBUTE_CHANGE."""
    return nation_dim(spark, base)


def _fallback_flat(t):
    o = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nat_key"))
    return o.join(c, "o_custkey")


@query("fact_load_fallback", sql=f"""WITH {V.customer_dim_sql(3)}, {NATION_DIM_SQL},
f AS (SELECT o.o_orderkey, o.o_custkey, c.c_nationkey AS nat_key, CAST(o.o_orderdate AS DATE) AS order_date
      FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
a AS (SELECT f.*, dc.effective_date AS cust_effective_date, dn.effective_date AS nat_effective_date
      FROM f
      LEFT JOIN dim3 dc ON dc.c_custkey = f.o_custkey AND f.order_date >= dc.effective_date AND f.order_date < dc.expiration_date
      LEFT JOIN ndim2 dn ON dn.n_nationkey = f.nat_key AND f.order_date >= dn.effective_date AND f.order_date < dn.expiration_date),
ec AS (SELECT c_custkey, min(effective_date) AS eff FROM dim3 GROUP BY c_custkey),
en AS (SELECT n_nationkey, min(effective_date) AS eff FROM ndim2 GROUP BY n_nationkey)
SELECT o_orderkey, o_custkey, nat_key, order_date, cust_effective_date, nat_effective_date, 'ASOF' AS resolution
FROM a WHERE cust_effective_date IS NOT NULL AND nat_effective_date IS NOT NULL
UNION ALL
SELECT a.o_orderkey, a.o_custkey, a.nat_key, a.order_date, ec.eff, en.eff, 'EARLIEST'
FROM a JOIN ec ON ec.c_custkey = a.o_custkey JOIN en ON en.n_nationkey = a.nat_key
WHERE NOT (a.cust_effective_date IS NOT NULL AND a.nat_effective_date IS NOT NULL)""")
def q_fact_load_fallback(spark, base):
    """FCT-02 with the half-open test: orders before the nation dim starts, or
    on a version's last day, take the earliest version of *both* dims."""
    t = Tables(spark, base)
    dims = [dict(dim=customer_dim(spark, base, 3), fact_key="o_custkey", dim_key="c_custkey",
                 take=["effective_date"], prefix="cust"),
            dict(dim=nation_dim(spark, base), fact_key="nat_key", dim_key="n_nationkey",
                 take=["effective_date"], prefix="nat")]
    return load_fact_fallback(_fallback_flat(t), dims, "order_date", closed=False)


@query("fact_earliest", sql=f"""WITH {V.customer_dim_sql(3)},
ec AS (SELECT c_custkey, min(effective_date) AS eff FROM dim3 GROUP BY c_custkey)
SELECT o.o_orderkey, o.o_custkey, ec.eff AS cust_effective_date
FROM orders o JOIN ec ON ec.c_custkey = o.o_custkey""")
def q_fact_earliest(spark, base):
    """FCT-03: earliest version, no as-of attempt."""
    from tessera.operators.facts import load_fact_earliest
    t = Tables(spark, base)
    o = t.orders.select("o_orderkey", "o_custkey")
    return load_fact_earliest(o, [dict(dim=customer_dim(spark, base, 3), fact_key="o_custkey",
                                       dim_key="c_custkey", take=["effective_date"], prefix="cust")])


@query("fact_current_upsert", sql=f"""WITH {V.customer_dim_sql(3)},
tgt AS (SELECT o.o_orderkey, d.c_mktsegment AS segment, o.o_totalprice AS amount
        FROM orders o JOIN dim2 d ON d.c_custkey = o.o_custkey AND d.is_current
        WHERE year(o.o_orderdate) <= 1998),
inc AS (SELECT o.o_orderkey, d.c_mktsegment AS segment, o.o_totalprice * 2 AS amount
        FROM orders o JOIN dim3 d ON d.c_custkey = o.o_custkey AND d.is_current)
SELECT coalesce(t.o_orderkey, i.o_orderkey) AS o_orderkey,
       CASE WHEN i.o_orderkey IS NOT NULL THEN i.segment ELSE t.segment END AS segment,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.amount ELSE i.amount END AS amount
FROM tgt t FULL OUTER JOIN inc i ON t.o_orderkey = i.o_orderkey""")
def q_fact_current_upsert(spark, base):
    """FCT-04 + SNK-04: facts keyed by order; a later load overwrites only the
    segment (from the current dim version), keeps the loaded amount, and
    inserts orders not loaded before."""
    from tessera.operators.facts import load_fact_current
    t = Tables(spark, base)
    o = t.orders
    def load(dim, amount):
        f = load_fact_current(o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"),
                              [dict(dim=dim, fact_key="o_custkey", dim_key="c_custkey",
                                    take=["c_mktsegment"], prefix="cur")])
        return f.select("o_orderkey", F.col("cur_c_mktsegment").alias("segment"),
                        amount.alias("amount"), "o_orderdate")
    target = load(customer_dim(spark, base, 2), F.col("o_totalprice")) \
        .where(F.year("o_orderdate") <= 1998).drop("o_orderdate")
    incoming = load(customer_dim(spark, base, 3), F.col("o_totalprice") * 2) \
        .drop("o_orderdate")
    return upsert(target, incoming, ["o_orderkey"], update_cols=["segment"])


@query("snapshot_fact", sql=f"""WITH {V.customer_dim_sql(3)}
SELECT c_custkey, DATE '{V.DAY3}' AS snapshot_date FROM dim3 WHERE is_current""")
def q_snapshot_fact(spark, base):
    """FCT-01: one row per current dim row on the business date."""
    return snapshot_fact(customer_dim(spark, base, 3), "c_custkey", V.DAY3)


@query("unresolved_rows", sql=f"""WITH {V.customer_dim_sql(3)},
flat AS (SELECT o_orderkey, o_custkey * 2 AS o_custkey, CAST(o_orderdate AS DATE) AS order_date FROM orders),
fact AS (SELECT f.o_orderkey FROM flat f JOIN dim3 d ON d.c_custkey = f.o_custkey
         AND f.order_date BETWEEN d.effective_date AND d.expiration_date
         UNION ALL
         SELECT f.o_orderkey FROM flat f JOIN (SELECT c_custkey, min(effective_date) e FROM dim3 GROUP BY 1) ec
           ON ec.c_custkey = f.o_custkey
         WHERE NOT EXISTS (SELECT 1 FROM dim3 d WHERE d.c_custkey = f.o_custkey
                             AND f.order_date BETWEEN d.effective_date AND d.expiration_date))
SELECT f.o_orderkey, f.o_custkey FROM flat f WHERE f.o_orderkey NOT IN (SELECT o_orderkey FROM fact)""")
def q_unresolved_rows(spark, base):
    """FCT-05: staged rows (customer key doubled, so many point nowhere) that
    the fact load could not resolve."""
    t = Tables(spark, base)
    flat = t.orders.select("o_orderkey", (F.col("o_custkey") * 2).alias("o_custkey"),
                           F.to_date("o_orderdate").alias("order_date"))
    fact = load_fact_fallback(flat, [dict(dim=customer_dim(spark, base, 3), fact_key="o_custkey",
                                          dim_key="c_custkey", take=["effective_date"], prefix="c")],
                              "order_date")
    return unresolved(flat, fact, ["o_orderkey"]).select("o_orderkey", "o_custkey")


_PART_TARGET = "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size <= 25"


@query("insert_if_absent", sql=f"""WITH tgt AS ({_PART_TARGET}),
inc AS (SELECT p_partkey, upper(p_name) AS p_name, p_retailprice FROM part
        UNION ALL SELECT CAST(NULL AS BIGINT), p_name, p_retailprice FROM part WHERE p_size > 45),
dedup AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY p_name, p_retailprice) rn
                         FROM inc WHERE p_partkey IS NOT NULL) x WHERE rn = 1)
SELECT * FROM tgt
UNION ALL SELECT p_partkey, p_name, p_retailprice FROM dedup d WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.p_partkey = d.p_partkey)
UNION ALL SELECT * FROM inc WHERE p_partkey IS NULL""")
def q_insert_if_absent(spark, base):
    """SNK-03: ON CONFLICT DO NOTHING; NULL keys never conflict."""
    t = Tables(spark, base)
    p = t.part
    target = p.where(F.col("p_size") <= 25).select("p_partkey", "p_name", "p_retailprice")
    incoming = p.select("p_partkey", F.upper("p_name").alias("p_name"), "p_retailprice") \
        .unionByName(p.where(F.col("p_size") > 45)
                      .select(F.lit(None).cast("long").alias("p_partkey"), "p_name", "p_retailprice"))
    return insert_if_absent(target, incoming, ["p_partkey"], order=["p_name", "p_retailprice"])


@query("upsert_partial", sql=f"""WITH tgt AS ({_PART_TARGET}),
inc AS (SELECT p_partkey, upper(p_name) AS p_name,
               CASE WHEN p_size = 30 THEN CAST(NULL AS DOUBLE) ELSE p_retailprice * 2 END AS p_retailprice
        FROM part WHERE p_size >= 20)
SELECT coalesce(t.p_partkey, i.p_partkey) AS p_partkey,
       CASE WHEN t.p_partkey IS NOT NULL THEN t.p_name ELSE i.p_name END AS p_name,
       CASE WHEN i.p_partkey IS NOT NULL THEN i.p_retailprice ELSE t.p_retailprice END AS p_retailprice
FROM tgt t FULL OUTER JOIN inc i ON t.p_partkey = i.p_partkey""")
def q_upsert_partial(spark, base):
    """SNK-04: only listed columns are overwritten; an incoming NULL overwrites."""
    t = Tables(spark, base)
    p = t.part
    target = p.where(F.col("p_size") <= 25).select("p_partkey", "p_name", "p_retailprice")
    incoming = p.where(F.col("p_size") >= 20).select(
        "p_partkey", F.upper("p_name").alias("p_name"),
        F.when(F.col("p_size") == 30, F.lit(None).cast("double"))
         .otherwise(F.col("p_retailprice") * 2).alias("p_retailprice"))
    return upsert(target, incoming, ["p_partkey"], update_cols=["p_retailprice"])


@query("surrogate_keys", sql=f"""WITH {V.customer_dim_sql(3)}
SELECT row_number() OVER (ORDER BY c_custkey, effective_date) + (SELECT max(n_nationkey) FROM nation) AS id,
       c_custkey, effective_date FROM dim3""")
def q_surrogate_keys(spark, base):
    """SNK-07: dense ids in natural-key order after the existing maximum."""
    t = Tables(spark, base)
    dim = customer_dim(spark, base, 3).select("c_custkey", "effective_date")
    start = t.nation.agg(F.max("n_nationkey")).first()[0]
    return assign_surrogate(dim, ["c_custkey", "effective_date"], base=int(start)) \
        .select("id", "c_custkey", "effective_date")


@query("latest_per_key", sql="""SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) rn
  FROM orders) x WHERE rn = 1""")
def q_latest_per_key(spark, base):
    """SCD-02 / WIN-02: the last order per customer (total-order tiebreak)."""
    t = Tables(spark, base)
    return pick_one(t.orders, ["o_custkey"], [("o_orderdate", "desc", "last"), ("o_orderkey", "desc")],
                    ["o_orderkey", "o_orderdate", "o_totalprice"])


@query("latest_before", sql="""SELECT e.event_id, e.user_id, e.ts, c.ts AS prev_ts,
       date_diff('second', c.ts, e.ts) AS gap_seconds
FROM events e ASOF LEFT JOIN (SELECT user_id, ts FROM events WHERE event_type IN ('click', 'view')) c
  ON e.user_id = c.user_id AND e.ts > c.ts""")
def q_latest_before(spark, base):
    """J-07: the latest earlier click/view of the same user, and the gap."""
    t = Tables(spark, base)
    ev = t.events.select("event_id", "user_id", "ts")
    cands = t.events.where(F.col("event_type").isin("click", "view")).select("user_id", "ts")
    out = latest_before(ev, cands, ["user_id"], ["user_id"], "ts", "ts", kind="timestamp",
                        out_time="prev_ts")
    return out.withColumn("gap_seconds", F.unix_seconds(F.col("ts").cast("timestamp"))
                          - F.unix_seconds(F.col("prev_ts").cast("timestamp")))

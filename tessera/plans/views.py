"""Source-shaped frames derived from the test tables, in Spark and in SQL.

The warehouse steps need dated snapshots, admin units, calendars and so on;
these are derived deterministically from the whole test tables with integer
arithmetic on keys, written once as DataFrame code and once as SQL text for
the oracle. Derivations change values or add rows; they never drop rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The business dates of the three customer snapshots and the
# segment rotation used by the second one.
DAY1, DAY2, DAY3 = "1995-01-01", "1997-01-01", "1999-01-01"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

CUSTOMER_KEY = ["c_custkey"]
CUSTOMER_TRACKED = ["c_name", "c_nationkey", "c_mktsegment"]
CUSTOMER_RULES = [("c_name", "Customer renamed"),
                  ("c_nationkey", "Nation re-assignment"),
                  ("c_mktsegment", "Segment changed")]


def _rotate(col):
    out = None
    for i, s in enumerate(SEGMENTS):
        nxt = SEGMENTS[(i + 1) % len(SEGMENTS)]
        out = F.when(col == s, F.lit(nxt)) if out is None else out.when(col == s, F.lit(nxt))
    return out.otherwise(col)


def first_supplier(lineitem: DataFrame, order: str, supplier: str) -> DataFrame:
    """One row per order that has lines: the supplier on its first line."""
    return lineitem.groupBy(F.col("l_orderkey").alias(order)).agg(
        F.min(F.struct("l_linenumber", "l_suppkey"))["l_suppkey"].alias(supplier))


def customer_day1(customer: DataFrame) -> DataFrame:
    return customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def customer_day2(customer: DataFrame) -> DataFrame:
    """Segments rotate for every 7th key; every 13th key gains a twin
    under a negative key, which no customer has at any size."""
    base = customer_day1(customer)
    k = F.col("c_custkey")
    changed = base.select("c_custkey", "c_name", "c_nationkey",
                          F.when(k % 7 == 0, _rotate(F.col("c_mktsegment")))
                           .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    new = (base.where(k % 13 == 0)
               .select((-k - 1).alias("c_custkey"),
                       F.concat(F.lit("New#"), k.cast("string")).alias("c_name"),
                       "c_nationkey", "c_mktsegment"))
    return changed.unionByName(new)


def customer_day3(customer: DataFrame) -> DataFrame:
    """Every 5th key renamed, every 11th moves nation, every 17th loses it."""
    d2 = customer_day2(customer)
    k = F.col("c_custkey")
    return d2.select(
        "c_custkey",
        F.when(k % 5 == 0, F.concat(F.col("c_name"), F.lit("-R"))).otherwise(F.col("c_name")).alias("c_name"),
        F.when(k % 17 == 0, F.lit(None).cast("int"))
         .when(k % 11 == 0, ((F.col("c_nationkey") + 1) % 25).cast("int"))
         .otherwise(F.col("c_nationkey")).alias("c_nationkey"),
        "c_mktsegment")


def _rotate_sql(col: str) -> str:
    parts = " ".join(f"WHEN {col} = '{s}' THEN '{SEGMENTS[(i + 1) % len(SEGMENTS)]}'"
                     for i, s in enumerate(SEGMENTS))
    return f"CASE {parts} ELSE {col} END"


CUSTOMER_SNAPSHOTS_SQL = f"""
snap1 AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
),
snap2 AS (
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_custkey % 7 = 0 THEN {_rotate_sql('c_mktsegment')} ELSE c_mktsegment END AS c_mktsegment
  FROM snap1
  UNION ALL
  SELECT -c_custkey - 1, 'New#' || CAST(c_custkey AS VARCHAR), c_nationkey, c_mktsegment
  FROM snap1 WHERE c_custkey % 13 = 0
),
snap3 AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 5 = 0 THEN c_name || '-R' ELSE c_name END AS c_name,
         CASE WHEN c_custkey % 17 = 0 THEN CAST(NULL AS INTEGER)
              WHEN c_custkey % 11 = 0 THEN CAST((c_nationkey + 1) % 25 AS INTEGER)
              ELSE c_nationkey END AS c_nationkey,
         c_mktsegment
  FROM snap2
)"""


def scd2_merge_sql(prev: str | None, snap: str, out: str, as_of: str, keys: list[str],
                   tracked: list[str], rules: list[tuple[str, str]] | None,
                   initial_fields: str, extra: list[str] | None = None) -> str:
    """SQL text of one SCD2 merge as CTEs ``<out>_s`` and ``<out>`` (oracle side).

    ``extra`` columns are carried untracked (from the old version when kept or
    expired, from the snapshot for new versions)."""
    key_eq = " AND ".join(f"c.{k} = s.{k}" for k in keys)
    cols = keys + tracked + (extra or [])
    hash_expr = "md5(concat_ws('|', " + ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), '')" for c in tracked) + "))"
    sel_s = ", ".join(f"s.{c}" for c in cols)
    sel_c = ", ".join(f"c.{c}" for c in cols)
    d = f"DATE '{as_of}'"
    if rules:
        reason = "CASE " + " ".join(f"WHEN c.{c} IS DISTINCT FROM s.{c} THEN '{t}'" for c, t in rules) \
                 + " ELSE 'Attribute update' END"
    else:
        reason = "'ATTRIBUTE_CHANGE'"
    fields = "concat_ws(',', " + ", ".join(
        f"CASE WHEN c.{c} IS DISTINCT FROM s.{c} THEN '{c}' END" for c in tracked) + ")"
    snap_cte = f"{out}_s AS (SELECT {', '.join(cols)}, {hash_expr} AS change_hash FROM {snap} " \
               f"WHERE {' AND '.join(f'{k} IS NOT NULL' for k in keys)})"
    if prev is None:
        body = (f"SELECT {sel_s}, {d} AS effective_date, DATE '9999-12-31' AS expiration_date, "
                f"TRUE AS is_current, s.change_hash, 'INITIAL_LOAD' AS change_reason, "
                f"'{initial_fields}' AS changed_fields FROM {out}_s s")
        return f"{snap_cte},\n{out} AS ({body})"
    ctrl = "c.effective_date, c.expiration_date, c.is_current, c.change_hash, c.change_reason, c.changed_fields"
    body = f"""
  SELECT {sel_c}, {ctrl} FROM {prev} c WHERE NOT c.is_current
  UNION ALL
  SELECT {sel_c}, {ctrl} FROM {prev} c LEFT JOIN {out}_s s ON {key_eq}
   WHERE c.is_current AND (s.{keys[0]} IS NULL OR s.change_hash = c.change_hash)
  UNION ALL
  SELECT {sel_c}, c.effective_date, CAST({d} - 1 AS DATE), FALSE, c.change_hash, c.change_reason, c.changed_fields
    FROM {prev} c JOIN {out}_s s ON {key_eq}
   WHERE c.is_current AND s.change_hash <> c.change_hash AND c.effective_date <> {d}
  UNION ALL
  SELECT {sel_s}, {d}, DATE '9999-12-31', TRUE, s.change_hash,
         CASE WHEN c.{keys[0]} IS NULL THEN 'INITIAL_LOAD' WHEN c.effective_date = {d} THEN c.change_reason ELSE {reason} END,
         CASE WHEN c.{keys[0]} IS NULL THEN '{initial_fields}' WHEN c.effective_date = {d} THEN c.changed_fields ELSE {fields} END
    FROM {out}_s s LEFT JOIN (SELECT * FROM {prev} WHERE is_current) c ON {key_eq}
   WHERE c.{keys[0]} IS NULL OR s.change_hash <> c.change_hash"""
    return f"{snap_cte},\n{out} AS ({body})"


def customer_dim_sql(days: int = 3) -> str:
    """CTE text building dim1..dimN from the customer snapshots."""
    parts = [CUSTOMER_SNAPSHOTS_SQL.strip()]
    dates = [DAY1, DAY2, DAY3]
    prev = None
    for i in range(days):
        out = f"dim{i + 1}"
        parts.append(scd2_merge_sql(prev, f"snap{i + 1}", out, dates[i], CUSTOMER_KEY,
                                    CUSTOMER_TRACKED, CUSTOMER_RULES, "ALL"))
        prev = out
    return ",\n".join(parts)


# ---------------------------------------------------------------------------
# Admin units (hierarchy nodes) from region / nation / supplier.
# One code per unit type; source_id = key * 10 + code, so ids of
# different types never collide at any scale.
# ---------------------------------------------------------------------------
UNIT_CODE = {"District": 1, "City": 2, "County": 3, "Sub County": 4, "Town Council": 5,
             "Municipality": 6, "Parish": 7, "Ward": 8, "Village": 9}

# (type, source table, key column, name suffix, parent type, parent key column)
UNIT_SPECS = [
    ("District", "region", "r_regionkey", "", None, None),
    ("City", "region", "r_regionkey", " CITY", "District", "r_regionkey"),
    ("County", "nation", "n_nationkey", "", "District", "n_regionkey"),
    ("Sub County", "nation", "n_nationkey", " SC", "County", "n_nationkey"),
    ("Town Council", "nation", "n_nationkey", " TC", "County", "n_nationkey"),
    ("Municipality", "nation", "n_nationkey", " MC", "District", "n_regionkey"),
    ("Parish", "supplier", "s_suppkey", " P", "Sub County", "s_nationkey"),
    ("Ward", "supplier", "s_suppkey", " W", "Sub County", "s_nationkey"),
    ("Village", "supplier", "s_suppkey", " V", "Parish", "s_suppkey"),
]
NAME_COL = {"region": "r_name", "nation": "n_name", "supplier": "s_name"}


def admin_units(region: DataFrame, nation: DataFrame, supplier: DataFrame) -> DataFrame:
    """admin_units_dim-shaped frame: id, source_id, admin_unit_type, name,
    child_id (the parent's source id), current_status.

    Counties of nations 9, 19, ... are expired with no current successor,
    which breaks the chains below them. id = 2 * source_id (+1 if expired).
    """
    src = {"region": region, "nation": nation, "supplier": supplier}
    out = None
    for typ, table, key, suffix, ptype, pkey in UNIT_SPECS:
        sid = F.col(key).cast("long") * 10 + UNIT_CODE[typ]
        parent = (F.col(pkey).cast("long") * 10 + UNIT_CODE[ptype]) if ptype else F.lit(None).cast("long")
        cur = (F.col(key) % 10 != 9) if typ == "County" else F.lit(True)
        part = src[table].select(
            sid.alias("source_id"), F.lit(typ).alias("admin_unit_type"),
            F.concat(F.col(NAME_COL[table]), F.lit(suffix)).alias("name"),
            parent.alias("child_id"), cur.alias("current_status"))
        out = part if out is None else out.unionByName(part)
    return out.select((F.col("source_id") * 2 + F.when(F.col("current_status"), 0).otherwise(1)).alias("id"),
                      "source_id", "admin_unit_type", "name", "child_id", "current_status")


def _admin_units_sql() -> str:
    parts = []
    for typ, table, key, suffix, ptype, pkey in UNIT_SPECS:
        parent = f"CAST({pkey} AS BIGINT) * 10 + {UNIT_CODE[ptype]}" if ptype else "CAST(NULL AS BIGINT)"
        cur = f"{key} % 10 <> 9" if typ == "County" else "TRUE"
        parts.append(f"SELECT CAST({key} AS BIGINT) * 10 + {UNIT_CODE[typ]} AS source_id, '{typ}' AS admin_unit_type, "
                     f"{NAME_COL[table]} || '{suffix}' AS name, {parent} AS child_id, {cur} AS current_status FROM {table}")
    body = "\n    UNION ALL ".join(parts)
    return f"""
admin_units AS (
  SELECT source_id * 2 + CASE WHEN current_status THEN 0 ELSE 1 END AS id,
         source_id, admin_unit_type, name, child_id, current_status
  FROM (
    {body}
  ) u
)"""


ADMIN_UNITS_SQL = _admin_units_sql()


# ---------------------------------------------------------------------------
# Term calendar (academic_year_teaching_periods) from the order years.
# Term start months, period labels, school types per term.
# ---------------------------------------------------------------------------
TERM_MONTH = {1: 1, 2: 5, 3: 9}
PERIOD_NAME = {1: "1", 2: "term 2", 3: "3"}
SCHOOL_TYPES = [1, 2, 3, 4]


def term_calendar(orders: DataFrame, supplier: DataFrame) -> DataFrame:
    """Year x term x school type rows (4 per year-term, differing start day),
    plus school-specific term-1 rows of the last year for suppliers with a
    negative balance. Term 3 of school type 4 is inactive."""
    years = orders.select(F.year("o_orderdate").alias("y")).distinct()
    combos = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(st).alias("st"))
                       for p in TERM_MONTH for st in SCHOOL_TYPES])
    g = years.select("y", F.explode(combos).alias("c")).select("y", "c.p", "c.st")
    month = F.when(F.col("p") == 1, TERM_MONTH[1]).when(F.col("p") == 2, TERM_MONTH[2]) \
             .otherwise(TERM_MONTH[3])
    glob = g.select(
        (F.col("y") * 100 + F.col("p") * 10 + F.col("st")).cast("long").alias("id"),
        F.col("y").cast("long").alias("academic_year_id"),
        F.col("p").cast("long").alias("teaching_period_id"),
        F.lit(None).cast("long").alias("school_id"),
        F.col("st").cast("long").alias("school_type_id"),
        F.make_date("y", month, F.col("st")).alias("start_date"),
        F.date_add(F.make_date("y", month, F.col("st")), 90).alias("end_date"),
        F.when((F.col("p") == 3) & (F.col("st") == 4), F.lit("inactive"))
         .otherwise(F.lit("active")).alias("status"))
    # The last order year is a single scalar.
    ly = orders.agg(F.max(F.year("o_orderdate")).alias("y")).first()["y"]
    school = supplier.where(F.col("s_acctbal") < 0).select(
        (F.lit(ly * 100 + 10 + 9000000000) + F.col("s_suppkey")).cast("long").alias("id"),
        F.lit(ly).cast("long").alias("academic_year_id"),
        F.lit(1).cast("long").alias("teaching_period_id"),
        F.col("s_suppkey").cast("long").alias("school_id"),
        F.lit(1).cast("long").alias("school_type_id"),
        F.make_date(F.lit(ly), F.lit(2), F.lit(15)).alias("start_date"),
        F.make_date(F.lit(ly), F.lit(5), F.lit(15)).alias("end_date"),
        F.lit("active").alias("status"))
    return glob.unionByName(school)


def academic_years(orders: DataFrame) -> DataFrame:
    return (orders.select(F.year("o_orderdate").alias("y")).distinct()
                  .select(F.col("y").cast("long").alias("id"),
                          F.concat(F.lit("ACADEMIC YEAR "), F.col("y").cast("string")).alias("name")))


def teaching_periods(spark) -> DataFrame:
    return spark.createDataFrame([(p, n) for p, n in PERIOD_NAME.items()], "id long, name string")


TERM_CALENDAR_SQL = f"""
yrs AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS y FROM orders),
combos AS (SELECT p, st FROM (VALUES {', '.join(f'({p},{st})' for p in TERM_MONTH for st in SCHOOL_TYPES)}) v(p, st)),
aytp AS (
  SELECT CAST(y * 100 + p * 10 + st AS BIGINT) AS id, y AS academic_year_id, CAST(p AS BIGINT) AS teaching_period_id,
         CAST(NULL AS BIGINT) AS school_id, CAST(st AS BIGINT) AS school_type_id,
         make_date(CAST(y AS INTEGER), CASE p WHEN 1 THEN {TERM_MONTH[1]} WHEN 2 THEN {TERM_MONTH[2]} ELSE {TERM_MONTH[3]} END, st) AS start_date,
         CAST(make_date(CAST(y AS INTEGER), CASE p WHEN 1 THEN {TERM_MONTH[1]} WHEN 2 THEN {TERM_MONTH[2]} ELSE {TERM_MONTH[3]} END, st) + 90 AS DATE) AS end_date,
         CASE WHEN p = 3 AND st = 4 THEN 'inactive' ELSE 'active' END AS status
  FROM yrs, combos
  UNION ALL
  SELECT CAST((SELECT max(y) FROM yrs) * 100 + 10 + 9000000000 + s_suppkey AS BIGINT), (SELECT max(y) FROM yrs), 1, s_suppkey, 1,
         make_date(CAST((SELECT max(y) FROM yrs) AS INTEGER), 2, 15), make_date(CAST((SELECT max(y) FROM yrs) AS INTEGER), 5, 15), 'active'
  FROM supplier WHERE s_acctbal < 0
),
ay AS (SELECT y AS id, 'ACADEMIC YEAR ' || CAST(y AS VARCHAR) AS name FROM yrs),
tp AS (SELECT CAST(id AS BIGINT) AS id, name FROM (VALUES {', '.join(f"({p}, '{n}')" for p, n in PERIOD_NAME.items())}) v(id, name))"""

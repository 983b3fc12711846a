"""Hierarchy, calendars, decodes, pivots and flag rules on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.operators import scd2
from tessera.operators.calendar import term_calendar, term_dates
from tessera.operators.dedupe import pick_one, unique_or_null
from tessera.operators.hierarchy import unit_to_district
from tessera.operators.joins import expand_over, or_join_terms
from tessera.plans import views as V
from tessera.plans.sqlfrag import first_live_sql, term_label_sql, year_label_sql
from tessera.plans.registry import Tables, query


def units(t: Tables):
    return V.admin_units(t.region, t.nation, t.supplier)


def _hier_branch(alias: str, typ: str, chain: list[str]) -> str:
    """One source-style branch: unit -> parents (type-blind) -> District."""
    joins, prev = [], alias
    for i, _ in enumerate(chain[:-1]):
        nxt = f"{alias}_p{i}"
        joins.append(f"JOIN admin_units {nxt} ON {nxt}.source_id = {prev}.child_id AND {nxt}.current_status")
        prev = nxt
    joins.append(f"JOIN admin_units dist ON dist.source_id = {prev}.child_id AND dist.admin_unit_type = 'District' "
                 f"AND dist.current_status")
    return (f"SELECT {alias}.id AS unit_dim_id, dist.id AS district_dim_id, dist.name AS district_name "
            f"FROM admin_units {alias} {' '.join(joins)} "
            f"WHERE {alias}.current_status AND {alias}.admin_unit_type = '{typ}'")


HIERARCHY_BODY = f"""{_hier_branch('pa', 'Parish', ['sc', 'co', 'di'])}
UNION ALL {_hier_branch('wa', 'Ward', ['sc', 'co', 'di'])}
UNION ALL {_hier_branch('sc', 'Sub County', ['co', 'di'])}
UNION ALL {_hier_branch('tc', 'Town Council', ['co', 'di'])}
UNION ALL {_hier_branch('co', 'County', ['di'])}
UNION ALL {_hier_branch('mu', 'Municipality', ['di'])}
UNION ALL {_hier_branch('ci', 'City', ['di'])}
UNION ALL SELECT id, id, name FROM admin_units WHERE admin_unit_type = 'District' AND current_status"""
HIERARCHY_SQL = f"WITH {V.ADMIN_UNITS_SQL.strip()}\n{HIERARCHY_BODY}"


@query("hierarchy_rollup", sql=HIERARCHY_SQL)
def q_hierarchy_rollup(spark, base):
    """HIR-01 / J-12: every current unit to its District (Village and units
    under an expired County yield no row)."""
    return unit_to_district(units(Tables(spark, base)))


AU_DAYS = ["1996-01-01", "1998-01-01"]


def _unit_snapshot(t, day: int):
    n = t.nation
    parts = []
    for typ, suffix, parent in [("County", "", "r"), ("Sub County", " SC", "n"), ("Town Council", " TC", "n")]:
        name = F.concat(F.col("n_name"), F.lit(suffix))
        if day == 2 and typ == "Sub County":
            name = F.when(F.col("n_nationkey") % 4 == 0, F.concat(name, F.lit(" NEW"))).otherwise(name)
        par = F.col("n_regionkey") if parent == "r" else F.col("n_nationkey")
        if day == 2 and typ == "Town Council":
            par = F.when(F.col("n_nationkey") % 6 == 0, F.lit(None).cast("int")).otherwise(par)
        parts.append(n.select(F.col("n_nationkey").cast("long").alias("unit_key"),
                              F.lit(typ).alias("admin_unit_type"), name.alias("name"),
                              par.cast("long").alias("parent_key")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _unit_snapshot_sql(day: int) -> str:
    sc_name = "n_name || ' SC'" if day == 1 else \
        "CASE WHEN n_nationkey % 4 = 0 THEN n_name || ' SC' || ' NEW' ELSE n_name || ' SC' END"
    tc_par = "CAST(n_nationkey AS BIGINT)" if day == 1 else \
        "CASE WHEN n_nationkey % 6 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(n_nationkey AS BIGINT) END"
    return (f"usnap{day} AS (SELECT CAST(n_nationkey AS BIGINT) AS unit_key, 'County' AS admin_unit_type, n_name AS name, "
            f"CAST(n_regionkey AS BIGINT) AS parent_key FROM nation UNION ALL "
            f"SELECT CAST(n_nationkey AS BIGINT), 'Sub County', {sc_name}, CAST(n_nationkey AS BIGINT) FROM nation UNION ALL "
            f"SELECT CAST(n_nationkey AS BIGINT), 'Town Council', n_name || ' TC', {tc_par} FROM nation)")


_UKEYS, _UTRACK = ["unit_key", "admin_unit_type"], ["name", "parent_key"]


@query("scd2_composite_key", sql=f"""WITH {_unit_snapshot_sql(1)}, {_unit_snapshot_sql(2)},
{V.scd2_merge_sql(None, 'usnap1', 'udim1', AU_DAYS[0], _UKEYS, _UTRACK, None, 'INITIAL_LOAD')},
{V.scd2_merge_sql('udim1', 'usnap2', 'udim2', AU_DAYS[1], _UKEYS, _UTRACK, None, 'INITIAL_LOAD')}
SELECT unit_key, admin_unit_type, name, parent_key, effective_date, expiration_date,
       is_current AS current_status, change_reason, changed_fields FROM udim2""")
def q_scd2_composite_key(spark, base):
    """SCD-01 on (source id, unit type): one nation key is three units."""
    t = Tables(spark, base)
    s1, s2 = _unit_snapshot(t, 1), _unit_snapshot(t, 2)
    dim = scd2.empty_dim(spark, s1, _UKEYS + _UTRACK).withColumnRenamed("is_current", "current_status")
    for snap, day in [(s1, AU_DAYS[0]), (s2, AU_DAYS[1])]:
        dim = scd2.scd2_merge(dim, snap, _UKEYS, _UTRACK, day, current_col="current_status")
    return dim.select("unit_key", "admin_unit_type", "name", "parent_key", "effective_date",
                      "expiration_date", "current_status", "change_reason", "changed_fields")


# --- academic periods from order labels -----------------------------------

def _period_labels(t):
    o = t.orders
    pr = F.col("o_orderpriority")
    name = (F.when(pr == "1-URGENT", F.concat(F.lit("ACADEMIC YEAR "), (F.year("o_orderdate") + 1).cast("string")))
             .when(pr == "2-HIGH", F.lit("")).otherwise(F.lit("Old")))
    period = (F.when(pr.like("4%"), F.lit("term 3")).when(pr.like("5%"), F.lit(None).cast("string"))
               .otherwise(F.substring(pr, 1, 1)))
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("start_date"),
                    name.alias("year_name"), period.alias("period_name"))


_PERIOD_LABELS_SQL = f"""labels AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'ACADEMIC YEAR ' || CAST(year(o_orderdate) + 1 AS VARCHAR)
              WHEN o_orderpriority = '2-HIGH' THEN '' ELSE 'Old' END AS year_name,
         CASE WHEN o_orderpriority LIKE '4%' THEN 'term 3' WHEN o_orderpriority LIKE '5%' THEN NULL
              ELSE substr(o_orderpriority, 1, 1) END AS period_name
  FROM orders),
periods AS (
  SELECT o_orderkey,
         {year_label_sql('year_name', 'start_date')} AS academic_year,
         {term_label_sql('period_name')} AS term
  FROM labels)"""


def _periods(t):
    lab = _period_labels(t)
    return lab.select("o_orderkey", rules.academic_year("year_name", "start_date").alias("academic_year"),
                      rules.term_label("period_name").alias("term"))


@query("academic_period", sql=f"WITH {_PERIOD_LABELS_SQL}\nSELECT * FROM periods")
def q_academic_period(spark, base):
    """D-01 / D-02: year from label digits (else the date's year); term label."""
    return _periods(Tables(spark, base))


@query("term_dates", sql=f"""WITH {_PERIOD_LABELS_SQL}
SELECT DISTINCT academic_year, term,
       make_date(academic_year, CASE term WHEN 'TERM 1' THEN 2 WHEN 'TERM 2' THEN 6 ELSE 9 END, 1) AS term_start_date
FROM periods""")
def q_term_dates(spark, base):
    """CAL-01: fixed term start dates (Feb 1 / Jun 1 / Sep 1)."""
    return term_dates(_periods(Tables(spark, base)))


def _global_terms(spark, t):
    cal = V.term_calendar(t.orders, t.supplier)
    ay, tp = V.academic_years(t.orders), V.teaching_periods(spark)
    act = cal.where((F.col("status") == "active") & F.col("school_id").isNull())
    one = term_calendar(act, ["academic_year_id", "teaching_period_id"],
                        [("school_type_id", "asc"), ("id", "asc")])
    return (one.join(F.broadcast(ay.select(F.col("id").alias("academic_year_id"), F.col("name").alias("ay_name"))),
                     "academic_year_id")
               .join(F.broadcast(tp.select(F.col("id").alias("teaching_period_id"), F.col("name").alias("tp_name"))),
                     "teaching_period_id")
               .select(rules.academic_year("ay_name", "start_date").alias("academic_year"),
                       rules.term_label("tp_name").alias("term"),
                       F.col("start_date").alias("term_start_date")))


@query("staff_term_cross", sql=f"""WITH {V.TERM_CALENDAR_SQL.strip()},
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY academic_year_id, teaching_period_id
                                                    ORDER BY school_type_id, id) rn
                       FROM aytp WHERE status = 'active' AND school_id IS NULL) x WHERE rn = 1),
terms AS (
  SELECT {year_label_sql('ay.name', 'one.start_date')} AS academic_year,
         {term_label_sql('tp.name')} AS term,
         one.start_date AS term_start_date
  FROM one JOIN ay ON ay.id = one.academic_year_id JOIN tp ON tp.id = one.teaching_period_id)
SELECT s.s_suppkey, terms.* FROM supplier s CROSS JOIN terms""")
def q_staff_term_cross(spark, base):
    """J-04 + CAL-02: every staff row gets each active global term once."""
    t = Tables(spark, base)
    staff = t.supplier.select("s_suppkey")
    return expand_over(staff, _global_terms(spark, t))


@query("term_or_join", sql=f"""WITH {V.TERM_CALENDAR_SQL.strip()}
SELECT s.s_suppkey, a.id AS term_row_id, a.start_date
FROM supplier s JOIN aytp a ON (a.school_id IS NULL OR a.school_id = s.s_suppkey) AND a.status = 'active'""")
def q_term_or_join(spark, base):
    """J-03: global terms for everyone plus the school's own terms, no dedupe."""
    t = Tables(spark, base)
    cal = V.term_calendar(t.orders, t.supplier).where(F.col("status") == "active") \
        .select(F.col("id").alias("term_row_id"), "start_date", F.col("school_id").alias("cal_school"))
    out = or_join_terms(t.supplier.select("s_suppkey"), cal, "s_suppkey", "cal_school")
    return out.select("s_suppkey", "term_row_id", "start_date")


# --- decodes and unique codes ----------------------------------------------

@query("code_maps", sql="""SELECT o_orderkey, code,
  CASE code WHEN 1 THEN 'PENDING' WHEN 2 THEN 'APPROVED' WHEN 3 THEN 'REJECTED' ELSE 'UNKNOWN' END AS transfer_status,
  CASE code WHEN 1 THEN 'COMPLETE' WHEN 2 THEN 'INCOMPLETE' WHEN 3 THEN 'UNDER CONSTRUCTION' WHEN 4 THEN 'PLANNED' END AS completion_status,
  CASE code WHEN 1 THEN 'PERMANENT' WHEN 2 THEN 'TEMPORARY' WHEN 3 THEN 'SEMI-PERMANENT' END AS usage_mode,
  CASE code WHEN 1 THEN 'GOOD' WHEN 2 THEN 'FAIR' WHEN 3 THEN 'POOR' WHEN 4 THEN 'DILAPIDATED' END AS condition,
  CASE code WHEN 1 THEN 'MALE' WHEN 2 THEN 'FEMALE' WHEN 3 THEN 'BOTH' WHEN 4 THEN 'NONE' END AS gender_usage,
  CASE code WHEN 1 THEN 'TEACHERS ONLY' WHEN 2 THEN 'LEARNERS ONLY' WHEN 3 THEN 'BOTH' END AS user_category
FROM (SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS code FROM orders) x""")
def q_code_maps(spark, base):
    """D-11a..f / CND-01: literal code decodes from the priority digit."""
    t = Tables(spark, base)
    o = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("code"))
    c = F.col("code")
    return o.select("o_orderkey", "code",
                    rules.code_map(c, rules.TRANSFER_STATUS, rules.TRANSFER_STATUS_ELSE).alias("transfer_status"),
                    rules.code_map(c, rules.COMPLETION_STATUS).alias("completion_status"),
                    rules.code_map(c, rules.USAGE_MODE).alias("usage_mode"),
                    rules.code_map(c, rules.CONDITION).alias("condition"),
                    rules.code_map(c, rules.GENDER_USAGE).alias("gender_usage"),
                    rules.code_map(c, rules.USER_CATEGORY).alias("user_category"))


@query("decode_status", sql="""SELECT o_orderstatus,
  CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'OPEN' WHEN 'P' THEN 'PARTIAL' ELSE 'UNKNOWN' END AS status_name,
  count(*) AS orders FROM orders GROUP BY o_orderstatus""")
def q_decode_status(spark, base):
    """CND-01 simple CASE with an ELSE, grouped."""
    t = Tables(spark, base)
    name = rules.code_map("o_orderstatus", {"F": "FINISHED", "O": "OPEN", "P": "PARTIAL"}, "UNKNOWN")
    return t.orders.groupBy("o_orderstatus").agg(F.first(name).alias("status_name"),
                                                 F.count(F.lit(1)).alias("orders"))


@query("unique_code_filter", sql="""WITH c AS (
  SELECT p_partkey, CASE WHEN p_size = 1 THEN NULL ELSE p_name || '-' || p_brand END AS code FROM part)
SELECT p_partkey, code FROM c
WHERE code IS NULL OR code IN (SELECT code FROM c WHERE code IS NOT NULL GROUP BY code HAVING count(*) = 1)""")
def q_unique_code_filter(spark, base):
    """FLT-06 / AGG-08: rows of a duplicated code all go; NULL codes stay."""
    t = Tables(spark, base)
    c = t.part.select("p_partkey", F.when(F.col("p_size") == 1, F.lit(None).cast("string"))
                      .otherwise(F.concat("p_name", F.lit("-"), "p_brand")).alias("code"))
    return unique_or_null(c, "code")


# --- best admin level -------------------------------------------------------

def _candidates(t):
    s = t.supplier.join(t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey"), "s_nationkey")
    C = V.UNIT_CODE
    return s.select(
        "s_suppkey",
        F.when(F.col("s_acctbal") < 0, F.col("s_suppkey") * 10)
         .otherwise(F.col("s_suppkey") * 10 + C["Parish"]).alias("parish_id"),
        F.when((F.col("s_acctbal") < 0) & (F.col("s_nationkey") % 2 == 0), F.lit(None).cast("long"))
         .otherwise(F.col("s_nationkey").cast("long") * 10 + C["Sub County"]).alias("sub_county_id"),
        (F.col("s_nationkey").cast("long") * 10 + C["County"]).alias("county_id"),
        (F.col("n_regionkey").cast("long") * 10 + C["District"]).alias("district_id"))


_LEVELS = ["parish_id", "sub_county_id", "county_id", "district_id"]


@query("verified_best_level", sql=f"""WITH {V.ADMIN_UNITS_SQL.strip()},
cand AS (
  SELECT s.s_suppkey,
         CASE WHEN s.s_acctbal < 0 THEN s.s_suppkey * 10 ELSE s.s_suppkey * 10 + {V.UNIT_CODE['Parish']} END AS parish_id,
         CASE WHEN s.s_acctbal < 0 AND s.s_nationkey % 2 = 0 THEN NULL ELSE CAST(s.s_nationkey AS BIGINT) * 10 + {V.UNIT_CODE['Sub County']} END AS sub_county_id,
         CAST(s.s_nationkey AS BIGINT) * 10 + {V.UNIT_CODE['County']} AS county_id,
         CAST(n.n_regionkey AS BIGINT) * 10 + {V.UNIT_CODE['District']} AS district_id
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey)
SELECT cand.s_suppkey, live.unit AS admin_unit_id, COALESCE({', '.join(_LEVELS)}) AS unverified_unit_id
FROM cand LEFT JOIN {first_live_sql('cand', 's_suppkey', _LEVELS, 'SELECT source_id FROM admin_units WHERE current_status')} live
  ON live.s_suppkey = cand.s_suppkey""")
def q_verified_best_level(spark, base):
    """D-09b / J-09: the first candidate level that exists among current
    units (D-09a, unverified coalesce, alongside)."""
    t = Tables(spark, base)
    cur = units(t).where("current_status").select(F.col("source_id").alias("__sid")).distinct()
    c = _candidates(t)
    # every level of a supplier is a candidate of one join; the first that is current wins
    each = c.select("s_suppkey", F.posexplode(F.array(*_LEVELS)).alias("__level", "__unit"))
    best = (each.join(cur, F.col("__unit") == F.col("__sid")).groupBy("s_suppkey")
            .agg(F.min(F.struct("__level", "__unit"))["__unit"].alias("admin_unit_id")))
    return c.join(best, "s_suppkey", "left").select("s_suppkey", "admin_unit_id", F.coalesce(*_LEVELS).alias("unverified_unit_id"))


# --- subtype tables, boarding and sex composition -------------------------------

_SUBTYPES = ["pre_primary", "primary", "secondary", "international", "certificate", "diploma"]


def _subtype(t, i: int):
    s = t.supplier
    k = F.col("s_suppkey")
    day = F.when(k % 7 == 0, F.lit(None).cast("boolean")).otherwise(k % 2 == 0)
    board = F.when(k % 11 == 0, F.lit(None).cast("boolean")).otherwise(k % 3 == 0)
    return s.where(F.col("s_nationkey") % 6 == i).select(
        F.col("s_suppkey").alias(f"{_SUBTYPES[i]}_school_id"),
        day.alias(f"{_SUBTYPES[i]}_day"), board.alias(f"{_SUBTYPES[i]}_board"))


def _subtype_sql(i: int) -> str:
    n = "st_" + _SUBTYPES[i]
    return (f"{n} AS (SELECT s_suppkey AS school_id, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_suppkey % 2 = 0 END AS d, "
            f"CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE s_suppkey % 3 = 0 END AS b FROM supplier WHERE s_nationkey % 6 = {i})")


def _sql_branch(names, labels):
    names = ["st_" + n for n in names]
    present = " OR ".join(f"{n}.school_id IS NOT NULL" for n in names)
    d = "COALESCE(" + ", ".join(f"{n}.d" for n in names) + ")"
    b = "COALESCE(" + ", ".join(f"{n}.b" for n in names) + ")"
    return (f"WHEN ({present}) THEN CASE WHEN {d} IS TRUE AND {b} IS FALSE THEN '{labels[0]}' "
            f"WHEN {d} IS FALSE AND {b} IS TRUE THEN '{labels[1]}' WHEN {d} IS TRUE AND {b} IS TRUE THEN '{labels[2]}' END")


@query("subtype_boarding", sql=f"""WITH {', '.join(_subtype_sql(i) for i in range(6))}
SELECT s.s_suppkey,
  CASE {_sql_branch(_SUBTYPES[:4], ('DAY SCHOOL', 'FULLY BOARDING', 'DAY AND BOARDING'))}
       {_sql_branch(_SUBTYPES[4:], ('NON RESIDENTIAL', 'RESIDENTIAL', 'BOTH RES/NON'))} END AS boarding_status,
  CASE WHEN s.s_acctbal > 0 IS TRUE AND (CASE WHEN s.s_suppkey % 4 = 0 THEN NULL ELSE s.s_suppkey % 3 <> 0 END) IS TRUE THEN 'MIXED'
       WHEN s.s_acctbal > 0 IS TRUE AND (CASE WHEN s.s_suppkey % 4 = 0 THEN NULL ELSE s.s_suppkey % 3 <> 0 END) IS NOT TRUE THEN 'FEMALES ONLY'
       WHEN (CASE WHEN s.s_suppkey % 4 = 0 THEN NULL ELSE s.s_suppkey % 3 <> 0 END) IS TRUE AND (s.s_acctbal > 0) IS NOT TRUE THEN 'MALES ONLY'
  END AS sex_composition
FROM supplier s
{' '.join(f'LEFT JOIN st_{n} ON st_{n}.school_id = s.s_suppkey' for n in _SUBTYPES)}""")
def q_subtype_boarding(spark, base):
    """D-06a / D-07a / J-20 / PRED-01: subtype rows merged by COALESCE."""
    t = Tables(spark, base)
    s = t.supplier.select("s_suppkey", "s_acctbal")
    for i in range(6):
        sub = _subtype(t, i)
        s = s.join(sub, F.col("s_suppkey") == F.col(f"{_SUBTYPES[i]}_school_id"), "left")
    trip = lambda n: (f"{n}_school_id", f"{n}_day", f"{n}_board")
    board = rules.boarding_status([trip(n) for n in _SUBTYPES[:4]], [trip(n) for n in _SUBTYPES[4:]])
    male = F.when(F.col("s_suppkey") % 4 == 0, F.lit(None).cast("boolean")).otherwise(F.col("s_suppkey") % 3 != 0)
    return s.select("s_suppkey", board.alias("boarding_status"),
                    rules.sex_composition(F.col("s_acctbal") > 0, male).alias("sex_composition"))


# --- pivots, windows, flags ----------------------------------------------------

_EVENT_TYPES = ["click", "view", "error", "purchase", "login"]


@query("pivot_documents", sql="""SELECT user_id,
  max(CASE WHEN upper(event_type) LIKE '%CLICK%' THEN value END) AS click_value,
  max(CASE WHEN upper(event_type) LIKE '%VIEW%' THEN value END) AS view_value,
  max(CASE WHEN upper(event_type) LIKE '%ERR%' THEN value END) AS error_value,
  max(CASE WHEN upper(event_type) LIKE '%P_RCH%' THEN value END) AS purchase_value,
  max(CASE WHEN upper(event_type) LIKE '%LOG%IN%' THEN value END) AS login_value
FROM events GROUP BY user_id""")
def q_pivot_documents(spark, base):
    """AGG-04 / PRED-04: row-to-column pivot by case-folded LIKE patterns."""
    t = Tables(spark, base)
    et = F.upper("event_type")
    pats = {"click_value": "%CLICK%", "view_value": "%VIEW%", "error_value": "%ERR%",
            "purchase_value": "%P_RCH%", "login_value": "%LOG%IN%"}
    return t.events.groupBy("user_id").agg(*[F.max(F.when(et.like(p), F.col("value"))).alias(n)
                                             for n, p in pats.items()])


@query("pivot_documents_window", sql="""SELECT event_id, user_id,
  max(CASE WHEN event_type = 'view' THEN value END) OVER (PARTITION BY user_id) AS user_max_view,
  max(CASE WHEN event_type = 'click' THEN value END) OVER (PARTITION BY user_id) AS user_max_click
FROM events""")
def q_pivot_documents_window(spark, base):
    """WIN-01: partition-wide conditional max, as an aggregate joined back
    (partial aggregation; no window task holding a whole hot key)."""
    t = Tables(spark, base)
    ev = t.events
    agg = ev.groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == "view", F.col("value"))).alias("user_max_view"),
        F.max(F.when(F.col("event_type") == "click", F.col("value"))).alias("user_max_click"))
    return ev.select("event_id", "user_id").join(agg, "user_id")


_FLAGS = {
    "has_secret": "lower(text) LIKE '%password%' OR lower(text) LIKE '%api_key%' OR text LIKE '%BEGIN PRIVATE KEY%'",
    "has_email": "text LIKE '%_@_%._%'",
    "has_license": "upper(text) LIKE '%LICENSE%'",
    "is_long": "n_chars > 10000",
    "is_french": "lang = 'fr'",
    "has_url": "text LIKE '%http://%' OR text LIKE '%https://%'",
}


@query("flags_bool_or", sql=f"""SELECT source, {', '.join(f'bool_or(coalesce({c}, FALSE)) AS {n}' for n, c in _FLAGS.items())},
  ({' + '.join(f'CAST(bool_or(coalesce({c}, FALSE)) AS INTEGER)' for c in _FLAGS.values())}) > 1 AS has_multiple
FROM documents GROUP BY source""")
def q_flags_bool_or(spark, base):
    """AGG-05 / D-05: six flags per group by BOOL_OR over whole texts, and
    whether more than one is set."""
    t = Tables(spark, base)
    aggs = [F.bool_or(F.coalesce(F.expr(c), F.lit(False))).alias(n) for n, c in _FLAGS.items()]
    g = t.documents.groupBy("source").agg(*aggs)
    return g.withColumn("has_multiple", rules.multiple_flags(*_FLAGS.keys()))


@query("discipline", sql="""WITH d AS (
  SELECT l_orderkey, count(*) AS total_subjects, count(*) FILTER (WHERE l_returnflag = 'R') AS science_count
  FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, d.total_subjects, d.science_count,
  CASE WHEN d.total_subjects IS NULL OR d.total_subjects = 0 THEN NULL
       WHEN d.science_count = d.total_subjects THEN 'SCIENCE' WHEN d.science_count = 0 THEN 'ARTS' ELSE 'BOTH' END AS discipline
FROM orders o LEFT JOIN d ON d.l_orderkey = o.o_orderkey""")
def q_discipline(spark, base):
    """D-16 / AGG-02: SCIENCE / ARTS / BOTH per order; none -> NULL."""
    t = Tables(spark, base)
    d = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("total_subjects"),
                                             F.count_if(F.col("l_returnflag") == "R").alias("science_count"))
    o = t.orders.select("o_orderkey").join(d, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return o.select("o_orderkey", "total_subjects", "science_count",
                    rules.discipline("science_count", "total_subjects").alias("discipline"))


@query("unpivot_union_distinct", sql="""SELECT l_orderkey AS person_id, l_partkey AS subject_id, 'PART' AS subject_level FROM lineitem
UNION SELECT l_orderkey, l_suppkey, 'SUPP' FROM lineitem""")
def q_unpivot_union_distinct(spark, base):
    """SET-02 / M-U0c: two key columns unpivoted by UNION (distinct rows)."""
    t = Tables(spark, base)
    li = t.lineitem
    a = li.select(F.col("l_orderkey").alias("person_id"), F.col("l_partkey").alias("subject_id"),
                  F.lit("PART").alias("subject_level"))
    b = li.select("l_orderkey", "l_suppkey", F.lit("SUPP"))
    return a.union(b).distinct()

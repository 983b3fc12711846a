"""Stored tables kept up run by run: upserts by partition, bucketed dimensions,
indicators from the facts, roll-ups of distinct counts, step log, error rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import rules as R
from tessera.operators import coverage, errors, tree
from tessera.operators.stored import StoredTable
from tessera.operators.stored_dim import StoredDimension
from tessera.plans import eduviews as E
from tessera.plans import q_edu as Q
from tessera.plans import views as V
from tessera.plans.marts import enrolment as EN
from tessera.plans.marts import schools as S
from tessera.plans.marts import teachers as TE
from tessera.plans.q_relational import HIERARCHY_BODY
from tessera.plans.registry import ORACLE, Tables, query
from tessera.plans.q_warehouse import DIM_COLS
from tessera.plans.sqlfrag import rate_sql
from tessera.operators.hierarchy import unit_to_district
from tessera.session import checkpoint_dir, materialize
from tessera.sources import extract as X


def upserted_sql(before: str, after: str, keys: list[str], columns: list[str], updated: list[str]) -> str:
    """Rows of ``before`` upserted with those of ``after``."""
    def pick(c):
        if c in keys:
            return f"coalesce(b.{c}, a.{c}) AS {c}"
        first, other = ("a", "b") if c in updated else ("b", "a")
        return f"CASE WHEN {first}.{keys[0]} IS NOT NULL THEN {first}.{c} ELSE {other}.{c} END AS {c}"
    on = " AND ".join(f"b.{k} = a.{k}" for k in keys)
    return f"SELECT {', '.join(map(pick, columns))} FROM {before} b FULL OUTER JOIN {after} a ON {on}"


# --- M-I3b: enrolment indicators, upserted by year ---------------------------------

EI_KEY = ["district_name", "school_level", "academic_year", "gender"]
EI_UPDATED = ["enrolment", "new_entrants_p1", "repeaters", "learners_with_disability", "school_age_population", "ger", "ner", "gir",
              "repetition_rate", "sne_inclusion_rate"]
EI_COLUMNS = [*EI_KEY, *EI_UPDATED, "population_age_6", "gpi_ger", "gpi_ner", "date_key"]


@query("mart_enrolment_indicator_upsert", sql=f"""WITH fact AS ({ORACLE['mart_enrolment_indicator_fact']}),
earlier AS (SELECT * REPLACE (enrolment - 1 AS enrolment, CAST(date_key - 1 AS DATE) AS date_key) FROM fact WHERE academic_year <= 1997
            UNION ALL
            SELECT * REPLACE (CAST(academic_year - 100 AS INTEGER) AS academic_year) FROM fact WHERE academic_year = 1995)
{upserted_sql('earlier', 'fact', EI_KEY, EI_COLUMNS, EI_UPDATED)}""")
def q_enrolment_indicator_upsert(spark, base):
    """M-I3b / SNK-04 on a stored table: an earlier run's rows (one less
    enrolled, another date, one year of long ago), then this run's, twice. Only
    the years of the batch are rewritten; the stored date is kept."""
    from tessera.plans.registry import QUERIES
    fact = materialize(QUERIES["mart_enrolment_indicator_fact"](spark, base).select(*EI_COLUMNS), "indicators")
    stale = fact.where("academic_year <= 1997").withColumn("enrolment", F.col("enrolment") - 1).withColumn("date_key", F.date_sub("date_key", 1))
    old = fact.where("academic_year = 1995").withColumn("academic_year", F.col("academic_year") - 100)
    table = StoredTable(spark, "enrolment_indicator_fact", fact.schema, EI_KEY, partition_by="academic_year")
    table.insert_if_absent(stale.unionByName(old))
    for batch in (fact, fact.where("academic_year > 1997")):
        table.upsert(batch, EI_UPDATED)
    return table.read()


# --- M-U1c: teaching subjects, upserted by person ----------------------------------

TS_KEY = ["person_id", "subject_source_id", "subject_level"]
TS_UPDATED = ["teacher_version", "school_id", "date_key"]
TS_COLUMNS = [*TS_KEY, *TS_UPDATED, "subject_category"]


def _ts_run_sql(n: int, day: str) -> str:
    return f"""ts{n} AS (SELECT f.person_id, f.subject_source_id, f.subject_level, f.school_id, tv.effective_date AS teacher_version,
       sd.subject_category, DATE '{day}' AS date_key
FROM ts_flat f
JOIN (SELECT person_id, min(effective_date) AS effective_date FROM tdim{n} WHERE is_current GROUP BY person_id) tv ON tv.person_id = f.person_id
JOIN subject_dim sd ON sd.source_id = f.subject_source_id AND sd.subject_level = f.subject_level)"""


@query("mart_teaching_subjects_upsert", sql=f"""WITH {Q.teacher_dim_sql(2)}, {Q.SUBJECT_DIM_SQL}, {Q.TS_FLAT_SQL},
{_ts_run_sql(1, Q.T_RUN1)}, {_ts_run_sql(2, Q.T_RUN2)}
{upserted_sql('ts1', 'ts2', TS_KEY, TS_COLUMNS, TS_UPDATED)}""")
def q_teaching_subjects_upsert(spark, base):
    """M-U1c / SNK-04: both runs' coverage upserted on (person, subject, level)."""
    t = Tables(spark, base)
    Q.taught_subjects(t, store=True)    # the teachers' counts read them too
    dims = Q.teacher_dims(spark, t, 2)
    table = None
    for dim, day in zip(dims, (Q.T_RUN1, Q.T_RUN2)):
        rows = Q.teaching_subject_fact(spark, t, dim, day).select(*TS_COLUMNS)
        table = table or StoredTable(spark, "teaching_subject_fact", rows.schema, TS_KEY, parts=16)
        table.upsert(rows, TS_UPDATED)
    return table.read()


# --- SCD-01 on bucketed, partitioned tables ----------------------------------------

@query("scd2_stored", sql=ORACLE["scd2_day3"])
def q_scd2_stored(spark, base):
    """SCD-01 / SNK-06: three runs and a replay merged into a stored dimension."""
    cust = Tables(spark, base).customer
    snaps = [V.customer_day1(cust), V.customer_day2(cust), V.customer_day3(cust)]
    dim = StoredDimension(spark, "customer_dim", snaps[0], V.CUSTOMER_KEY, V.CUSTOMER_TRACKED)
    for snap, day in zip([*snaps, snaps[-1]], (V.DAY1, V.DAY2, V.DAY3, V.DAY3)):
        dim.merge(snap, day, reason_rules=V.CUSTOMER_RULES, initial_fields="ALL")
    return dim.read().select(*DIM_COLS)


def school_snapshot(spark, t, day, adim):
    """The day's schools with the surrogate of their admin unit."""
    units = adim.where(F.col("current_status")).groupBy(F.col("source_id").alias("au")).agg(F.min("id").alias("au_id"))
    flat = Q.schools_flat(spark, t, day, adim)
    return flat.join(units, F.col("admin_unit_id") == F.col("au"), "left").withColumn("admin_unit_id", F.col("au_id")).drop("au", "au_id")


@query("mart_schools_dim_stored", sql=ORACLE["mart_schools_dim"])
def q_schools_dim_stored(spark, base):
    """M-S2 / SCD-01: schools over two runs in a stored dimension."""
    t = Tables(spark, base)
    dim = None
    for day, (adim, as_of) in enumerate(zip(Q.admin_dims(t, 2), (Q.RUN1, Q.RUN2)), start=1):
        snap = school_snapshot(spark, t, day, adim)
        dim = dim or StoredDimension(spark, "schools_dim", snap, ["source_id"], S.SCHOOL_TRACKED)
        dim.merge(snap, as_of, reason_rules=S.SCHOOL_REASONS, initial_fields="ALL")
    return dim.read()


# --- M-I2 / M-I3c: school indicators from the facts, kept up by changes ------------

SI_KEY = ["school", "academic_year", "term"]
SI_UPDATED = ["learners", "teachers", "ptr", "pct_qualified", "pct_trained", "pct_female_teachers", "gpi_ptr", "male_learners", "female_learners",
              "male_teachers", "female_teachers", "qualified_teachers", "trained_teachers", "school_name", "school_type", "district_name"]
ENROLMENT_FACT = ["learner_id", "school_id", "academic_year", "term"]
UNITS_NOW = HIERARCHY_BODY.replace("admin_units", "units_now")
HR_FACT = ["person_id", "school_id", "academic_year", "term"]
# Spellings of the two sexes, and the trained teacher types.
MALE, FEMALE, QUALIFIED, TRAINED = ("M", "MALE"), ("F", "FEMALE"), ("QUALIFIED",), ("QUALIFIED", "TRAINED")


def indicators_of_schools(enrolments, staff, learners, teachers, schools, districts):
    """Ratios per school, year and term: teachers of the term against the
    learners of the whole year, as the facts and the current versions have them."""
    is_in = lambda c, names: F.upper(F.col(c)).isin(*names)
    pupils = enrolments.join(learners.where("is_current").select("learner_id", "gender"), "learner_id")
    pupils = pupils.groupBy(F.col("school_id").cast("long").alias("school"), "academic_year").agg(
        F.count(F.lit(1)).alias("learners"), F.count_if(is_in("gender", MALE)).alias("male_learners"),
        F.count_if(is_in("gender", FEMALE)).alias("female_learners"))
    staffed = staff.join(teachers.where("is_current").select("person_id", "gender", "teacher_type"), "person_id")
    staffed = staffed.groupBy(F.col("school_id").cast("long").alias("school"), "academic_year", "term").agg(
        F.count(F.lit(1)).alias("teachers"), F.count_if(is_in("gender", MALE)).alias("male_teachers"),
        F.count_if(is_in("gender", FEMALE)).alias("female_teachers"), F.count_if(is_in("teacher_type", QUALIFIED)).alias("qualified_teachers"),
        F.count_if(is_in("teacher_type", TRAINED)).alias("trained_teachers"))
    named = schools.where("is_current").select(F.col("source_id").cast("long").alias("school"), F.col("name").alias("school_name"), "school_type", "admin_unit_id")
    place = districts.select(F.col("unit_dim_id").alias("admin_unit_id"), "district_name")
    j = staffed.join(pupils, ["school", "academic_year"], "left").join(named, "school", "left").join(place, "admin_unit_id", "left")
    for c in ("learners", "male_learners", "female_learners"):
        j = j.withColumn(c, F.coalesce(c, F.lit(0)))
    both = (F.col("female_teachers") > 0) & (F.col("male_teachers") > 0) & (F.col("male_learners") > 0)
    return j.select(
        *SI_KEY, "learners", "teachers", R.rate("learners", "teachers", scale=1).alias("ptr"), R.rate("qualified_teachers", "teachers").alias("pct_qualified"),
        R.rate("trained_teachers", "teachers").alias("pct_trained"), R.rate("female_teachers", "teachers").alias("pct_female_teachers"),
        F.when(both, R.rate(F.col("female_learners") * F.col("male_teachers"), F.col("female_teachers") * F.col("male_learners"), scale=1, digits=4)).alias("gpi_ptr"),
        "male_learners", "female_learners", "male_teachers", "female_teachers", "qualified_teachers", "trained_teachers",
        "school_name", "school_type", "district_name")


def _run_state(spark, t, n):
    """Dimensions and district map after run ``n``."""
    adim = Q.admin_dims(t, n, (Q.E_RUN1, Q.E_RUN2))[-1]
    schools = Q.schools_dim(spark, t, n, (Q.E_RUN1, Q.E_RUN2))
    return Q.learner_dims(spark, t, n)[-1], Q.teacher_dims(spark, t, n)[-1], schools, unit_to_district(adim)


def _loaded(spark, t, n):
    """Fact rows that run ``n`` brings: (enrolments, staff)."""
    learners, teachers, schools, _ = _run_state(spark, t, n)
    enrolments = EN.enrolment_fact(Q.enrolments_flat(spark, t, n, (Q.E_RUN1, Q.E_RUN2)[n - 1]), learners, schools).select(*ENROLMENT_FACT)
    staff = TE.hr_fact(Q.teachers_flat(spark, t, n, (Q.T_RUN1, Q.T_RUN2)[n - 1]), teachers, schools).select(*HR_FACT)
    return enrolments, staff


def _facts(spark, t):
    """Both facts as stored tables, after each of two loads."""
    def build():
        first, second = _loaded(spark, t, 1), _loaded(spark, t, 2)
        tables = (StoredTable(spark, "enrolment_fact", first[0].schema, ENROLMENT_FACT, partition_by="academic_year"),
                  StoredTable(spark, "hr_fact", first[1].schema, HR_FACT, partition_by="academic_year"))
        runs = []
        for batch in (first, second):
            for table, rows in zip(tables, batch):
                table.insert_if_absent(rows)
            runs.append([materialize(table.read(), "facts") for table in tables])
        return runs
    return t.step("stored_facts", build)


def changed_groups(before, after, keys, groups):
    """Groups that hold rows of ``after`` whose key ``before`` lacks."""
    return after.join(before.select(*keys), keys, "left_anti").select(*groups).distinct()


def changed_members(before, after, key, columns):
    """Keys whose current version has other values in ``columns`` than before."""
    old, new = (d.where("is_current").select(key, F.xxhash64(*columns).alias(n)) for d, n in ((before, "h0"), (after, "h1")))
    return new.join(old, key, "full_outer").where(~F.col("h0").eqNullSafe(F.col("h1"))).select(key)


def _school_year(df):
    return df.select(F.col("school_id").cast("long").alias("school"), "academic_year")


def _si_sql(n: int) -> str:
    """Indicators over all facts that runs 1 to ``n`` loaded, with the current
    versions of run ``n``."""
    runs = range(1, n + 1)
    known = lambda flat, dim, key, i: (
        f"SELECT {i} AS run, f.{key}, f.school_id, f.academic_year, f.term FROM {flat}{i} f WHERE f.{key} IN (SELECT {key} FROM {dim}{i})")
    keys = lambda of, key: " UNION ".join(
        f"SELECT {key}, school_id, academic_year, term FROM {of} WHERE run = {i} AND school_id IN (SELECT source_id FROM sdim{i})" for i in runs)
    sex = lambda c, names: f"upper({c}) IN ({', '.join(repr(x) for x in names)})"
    return f"""el AS ({' UNION ALL '.join(known('eflat', 'ldim', 'learner_id', i) for i in runs)}),
hl AS (WITH {Q.teacher_dim_sql(n)} {' UNION ALL '.join(known('tflat', 'tdim', 'person_id', i) for i in runs)}),
tnow AS (WITH {Q.teacher_dim_sql(n)} SELECT person_id, gender, teacher_type FROM tdim{n} WHERE is_current),
ek AS ({keys('el', 'learner_id')}), hk AS ({keys('hl', 'person_id')}),
ec AS (SELECT school_id, academic_year, count(*) AS learners, count(*) FILTER (WHERE {sex('d.gender', MALE)}) AS male_learners,
              count(*) FILTER (WHERE {sex('d.gender', FEMALE)}) AS female_learners
       FROM ek JOIN ldim{n} d ON d.learner_id = ek.learner_id AND d.is_current GROUP BY school_id, academic_year),
tc AS (SELECT school_id, academic_year, term, count(*) AS teachers, count(*) FILTER (WHERE {sex('d.gender', MALE)}) AS male_teachers,
              count(*) FILTER (WHERE {sex('d.gender', FEMALE)}) AS female_teachers,
              count(*) FILTER (WHERE {sex('d.teacher_type', QUALIFIED)}) AS qualified_teachers,
              count(*) FILTER (WHERE {sex('d.teacher_type', TRAINED)}) AS trained_teachers
       FROM hk JOIN tnow d ON d.person_id = hk.person_id GROUP BY school_id, academic_year, term),
units_now AS (SELECT id, source_id, admin_unit_type, name, child_id, is_current AS current_status FROM adim{n}),
u2d AS ({UNITS_NOW}),
si AS (
  SELECT CAST(tc.school_id AS BIGINT) AS school, tc.academic_year, tc.term, coalesce(ec.learners, 0) AS learners, tc.teachers,
         coalesce(ec.male_learners, 0) AS male_learners, coalesce(ec.female_learners, 0) AS female_learners,
         tc.male_teachers, tc.female_teachers, tc.qualified_teachers, tc.trained_teachers,
         sd.name AS school_name, sd.school_type, u.district_name
  FROM tc LEFT JOIN ec ON ec.school_id = tc.school_id AND ec.academic_year = tc.academic_year
  LEFT JOIN sdim{n} sd ON sd.source_id = tc.school_id AND sd.is_current LEFT JOIN u2d u ON u.unit_dim_id = sd.admin_unit_id)
SELECT *, {rate_sql('learners', 'teachers', 1, 2)} AS ptr, {rate_sql('qualified_teachers', 'teachers', 100, 2)} AS pct_qualified,
       {rate_sql('trained_teachers', 'teachers', 100, 2)} AS pct_trained, {rate_sql('female_teachers', 'teachers', 100, 2)} AS pct_female_teachers,
       CASE WHEN female_teachers > 0 AND male_teachers > 0 AND male_learners > 0
            THEN {rate_sql('female_learners * male_teachers', 'female_teachers * male_learners', 1, 4)} END AS gpi_ptr
FROM si"""


SI_SQL = f"WITH {Q.learner_dim_sql(2)}, {Q.schools_dim_sql(2, (Q.E_RUN1, Q.E_RUN2), shared=False)}, {_si_sql(2)}"


@query("mart_school_indicators", sql=SI_SQL)
def q_school_indicators_of_facts(spark, base):
    """M-I2: school ratios by term with district, from the stored facts."""
    t = Tables(spark, base)
    return indicators_of_schools(*_facts(spark, t)[1], *_run_state(spark, t, 2))


@query("mart_school_indicators_incremental", sql=SI_SQL)
def q_school_indicators_incremental(spark, base):
    """M-I2 / M-I3c / SNK-04: run 1's indicators are stored; run 2 aggregates
    only the groups that its changes touch (new fact rows, members and schools
    whose current version says something else) and upserts those."""
    t = Tables(spark, base)
    (e1, h1), (e2, h2) = _facts(spark, t)
    (l1, t1, s1, d1), (l2, t2, s2, d2) = _run_state(spark, t, 1), _run_state(spark, t, 2)
    first = indicators_of_schools(e1, h1, l1, t1, s1, d1)
    table = StoredTable(spark, "school_indicator_fact", first.schema, SI_KEY, partition_by="academic_year")
    table.upsert(first, SI_UPDATED)
    place = lambda s, d: s.join(d.select(F.col("unit_dim_id").alias("admin_unit_id"), "district_name"), "admin_unit_id", "left")
    schools = changed_members(place(s1, d1), place(s2, d2), "source_id", ["name", "school_type", "district_name"])
    touched = _school_year(changed_groups(e1, e2, ENROLMENT_FACT, ["school_id", "academic_year"]))
    touched = touched.union(_school_year(changed_groups(h1, h2, HR_FACT, ["school_id", "academic_year"])))
    touched = touched.union(_school_year(e2.join(changed_members(l1, l2, "learner_id", ["gender"]), "learner_id")))
    touched = touched.union(_school_year(h2.join(changed_members(t1, t2, "person_id", ["gender", "teacher_type"]), "person_id")))
    touched = touched.union(_school_year(h2.join(schools, F.col("school_id").cast("long") == F.col("source_id").cast("long"))))
    touched = materialize(touched.distinct(), "touched")
    some = lambda f: f.join(touched, (F.col("school_id").cast("long") == touched["school"]) & (f["academic_year"] == touched["academic_year"]), "left_semi")
    table.upsert(indicators_of_schools(some(e2), some(h2), l2, t2, s2, d2), SI_UPDATED)
    return table.read()


# --- RPT-9: who teaches what, by school, district and country ----------------------

RPT9_SQL = f"""WITH {Q.teacher_dim_sql(2)}, {E.LOOKUPS_SQL}, {E.SUBTYPES_SQL}, {Q.schools_dim_sql(2, (Q.E_RUN1, Q.E_RUN2), shared=False)}, {Q.SUBJECT_DIM_SQL}, {Q.TS_FLAT_SQL},
units_now AS (SELECT id, source_id, admin_unit_type, name, child_id, is_current AS current_status FROM adim2),
u2d AS ({UNITS_NOW}),
taught AS (SELECT f.person_id, f.school_id, f.subject_level, sd.subject_category, u.district_name
           FROM ts_flat f JOIN subject_dim sd ON sd.source_id = f.subject_source_id AND sd.subject_level = f.subject_level
           LEFT JOIN sdim2 s ON s.source_id = f.school_id AND s.is_current LEFT JOIN u2d u ON u.unit_dim_id = s.admin_unit_id)
SELECT CASE WHEN grouping(school_id) = 0 THEN 'SCHOOL' WHEN grouping(district_name) = 0 THEN 'DISTRICT' ELSE 'COUNTRY' END AS area,
       CASE WHEN grouping(school_id) = 0 THEN CAST(school_id AS VARCHAR) WHEN grouping(district_name) = 0 THEN district_name END AS name,
       count(DISTINCT person_id) AS teachers, count(DISTINCT person_id) FILTER (WHERE subject_level = 'PRIMARY') AS primary_teachers,
       count(DISTINCT person_id) FILTER (WHERE subject_level = 'SECONDARY') AS secondary_teachers,
       count(DISTINCT person_id) FILTER (WHERE subject_category = 'SCIENCE') AS science_teachers,
       count(DISTINCT person_id) FILTER (WHERE subject_category = 'ARTS') AS arts_teachers,
       count(DISTINCT person_id) FILTER (WHERE subject_category = 'LANGUAGE') AS language_teachers
FROM taught GROUP BY GROUPING SETS ((school_id), (district_name), ())"""


@query("report_subject_teachers", sql=RPT9_SQL)
def q_report_subject_teachers(spark, base):
    """RPT-9: distinct teachers by level and subject category per school,
    district and country. The fact is read once, into bitmaps per school; the
    other levels merge those, so a teacher of two schools counts once."""
    t = Tables(spark, base)
    cats = Q.sized(Q.subject_dim(t)).select(F.col("source_id").alias("subject_source_id"), "subject_level", "subject_category")
    taught = Q.teaching_subject_flat(spark, t).join(cats, ["subject_source_id", "subject_level"])
    fine = ["school_id", "subject_level", "subject_category"]
    bits = materialize(coverage.bitmaps(taught, fine, "person_id"), "taught")
    _, _, schools, districts = _run_state(spark, t, 2)
    place = schools.where("is_current").select(F.col("source_id").cast("long").alias("__s"), F.col("admin_unit_id").alias("unit_dim_id")).join(districts, "unit_dim_id").select("__s", "district_name")
    bits = materialize(bits.join(place, F.col("school_id").cast("long") == F.col("__s"), "left").drop("__s"), "taught")
    is_ = lambda c, v: F.col(c) == v
    counts = {"teachers": None, "primary_teachers": is_("subject_level", "PRIMARY"), "secondary_teachers": is_("subject_level", "SECONDARY"),
              "science_teachers": is_("subject_category", "SCIENCE"), "arts_teachers": is_("subject_category", "ARTS"),
              "language_teachers": is_("subject_category", "LANGUAGE")}
    by = [("SCHOOL", ["school_id"], F.col("school_id").cast("string")), ("DISTRICT", ["district_name"], F.col("district_name")),
          ("COUNTRY", [], F.lit(None).cast("string"))]
    out = None
    for area, groups, name in by:
        level = coverage.distinct_counts(bits, groups, counts).select(F.lit(area).alias("area"), name.alias("name"), *counts)
        out = level if out is None else out.union(level)
    return out


# --- AUD-3 / SRC-06: a step log from the writes themselves -------------------------

@query("audit_steps_observed", sql="""SELECT 'nightly' AS run_id, 1 AS step_no, 'extract' AS step_name, (SELECT count(*) FROM orders) AS rows_written
UNION ALL SELECT 'nightly', 2, 'flat', (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P')
UNION ALL SELECT 'nightly', 3, 'snapshot', (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus <> 'P')""")
def q_audit_steps_observed(spark, base):
    """AUD-3 / SRC-06 / AGG-10: three steps, each written once; their row
    counts are observed by the writes."""
    orders = Tables(spark, base).orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    steps = [("extract", orders), ("flat", lambda done: done["extract"].where("o_orderstatus <> 'P'")),
             ("snapshot", lambda done: done["flat"].select("o_custkey").distinct())]
    return errors.run_steps(spark, "nightly", steps)[1]


# --- AUD-5: rejected rows ----------------------------------------------------------

@query("error_rows", sql="""WITH j AS (SELECT s_suppkey, s_nationkey, CAST(to_json(struct_pack(s_suppkey := s_suppkey, s_name := s_name,
              s_nationkey := CASE WHEN s_suppkey % 19 = 0 THEN NULL ELSE s_nationkey END)) AS VARCHAR) AS j0 FROM supplier)
SELECT 'run-2' AS run_id, 'supplier' AS source_table, CASE WHEN s_suppkey % 17 = 0 THEN substr(j0, 1, 12) ELSE j0 END AS raw_data,
       CASE WHEN s_suppkey % 17 = 0 THEN 'NOT_DECODABLE' ELSE 'MISSING_S_NATIONKEY' END AS reason
FROM j WHERE s_suppkey % 17 = 0 OR s_suppkey % 19 = 0
UNION ALL
SELECT 'run-1', 'supplier', substr(j0, 1, 12), 'NOT_DECODABLE' FROM j WHERE s_suppkey % 17 = 0""")
def q_error_rows(spark, base):
    """AUD-5: two runs' rejected rows with their reason; the second, which also
    asks for a nation, is repeated and replaces only its own."""
    s = Tables(spark, base).supplier.select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 19 != 0, F.col("s_nationkey")).alias("s_nationkey"))
    rows = X.rows_as_json(s, key="s_suppkey").select(
        F.when(F.col("s_suppkey") % 17 == 0, F.substring("row_json", 1, 12)).otherwise(F.col("row_json")).alias("row_json"))
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()), T.StructField("s_nationkey", T.IntegerType())])
    root = f"{checkpoint_dir(spark).rstrip('/')}/errors/{uuid.uuid4().hex[:12]}"
    for run, required in (("run-1", []), ("run-2", ["s_nationkey"]), ("run-2", ["s_nationkey"])):
        errors.split_write(rows, "row_json", schema, "supplier", run, root, required)
    return errors.read_errors(spark, root)


# --- HIR-01 / J-12 of any depth ----------------------------------------------------

TREE_SQL = """WITH RECURSIVE n AS (SELECT event_id AS id, CASE WHEN event_type = 'signup' THEN NULL
         WHEN event_id % 97 = 0 THEN -event_id - 1 WHEN event_type = 'error' AND event_id % 5 = 0 THEN event_id
         ELSE event_id - 1 - event_id % 3 END AS parent, event_type AS kind FROM events),
ids AS (SELECT id FROM n),
up AS (SELECT id, id AS at, 0 AS depth FROM n UNION ALL
       SELECT up.id, n.parent, up.depth + 1 FROM up JOIN n ON n.id = up.at JOIN ids ON ids.id = n.parent WHERE n.parent <> n.id),
ends AS (SELECT up.id, up.at, up.depth, n.parent, n.parent IS NOT NULL AND n.parent = n.id AS cycle,
                n.parent IS NOT NULL AND n.parent NOT IN (SELECT id FROM ids) AS orphan FROM up JOIN n ON n.id = up.at
         WHERE n.parent IS NULL OR n.parent = n.id OR n.parent NOT IN (SELECT id FROM ids)),
clicks AS (SELECT up.id, arg_min(up.at, up.depth) AS c FROM up JOIN n ON n.id = up.at WHERE n.kind = 'click' GROUP BY up.id)
SELECT e.id, CASE WHEN NOT cycle THEN e.at END AS root, CASE WHEN NOT cycle THEN CAST(e.depth AS BIGINT) END AS depth,
       CASE WHEN cycle THEN 'CYCLE' WHEN orphan THEN 'ORPHAN' ELSE 'OK' END AS status, clicks.c AS nearest_click
FROM ends e LEFT JOIN clicks ON clicks.id = e.id"""


@query("hierarchy_any_depth", sql=TREE_SQL)
def q_hierarchy_any_depth(spark, base):
    """HIR-01 / J-12: chains of events of any length up to a sign-up, with
    orphans and cycles reported, and the nearest click above each event."""
    e = F.col("event_id")
    parent = (F.when(F.col("event_type") == "signup", F.lit(None)).when(e % 97 == 0, -e - 1)
              .when((F.col("event_type") == "error") & (e % 5 == 0), e).otherwise(e - 1 - e % 3))
    nodes = Tables(spark, base).events.select(e.alias("id"), parent.alias("parent"), F.col("event_type").alias("kind"))
    return tree.climb(nodes, "id", "parent", "kind", ("click",))


# --- SRC-11 / AUD-6 as a stream ----------------------------------------------------

@query("stream_latest", sql="""SELECT o_custkey AS key, max(o_orderdate) AS latest, count(*) AS arrivals FROM orders GROUP BY o_custkey""")
def q_stream_latest(spark, base):
    """SRC-11: an ``availableNow`` stream over the orders whose state keeps the
    newest row of each customer, run twice: the second run finds nothing new."""
    from tessera.streaming.latest import run_latest
    orders = Tables(spark, base).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    root = f"{checkpoint_dir(spark).rstrip('/')}/streams/latest-{uuid.uuid4().hex[:12]}"
    orders.where(F.col("o_orderkey") % 2 == 0).write.parquet(f"{root}/source/part=0")
    run_latest(spark, f"{root}/source", orders.schema, "o_custkey", "o_orderdate", root)
    orders.where(F.col("o_orderkey") % 2 == 1).write.parquet(f"{root}/source/part=1")
    run_latest(spark, f"{root}/source", orders.schema, "o_custkey", "o_orderdate", root)
    return run_latest(spark, f"{root}/source", orders.schema, "o_custkey", "o_orderdate", root)


# --- SRC-04 / SRC-05 / SNK-01: resumed copies, versions, changing schemas ----------

@query("copy_resumed", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def q_copy_resumed(spark, base):
    """SRC-04: orders copied in key ranges; the copy stops after three chunks
    and is resumed from its ledger."""
    from tessera.sources import copy as C
    orders = Tables(spark, base).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    target = f"{checkpoint_dir(spark).rstrip('/')}/copies/{uuid.uuid4().hex[:12]}"
    C.copy_in_chunks(orders, "o_orderkey", target, chunks=8, at_most=3)
    C.copy_in_chunks(orders, "o_orderkey", target, chunks=8)
    return C.copied(spark, orders, target)


@query("reload_versions", sql="""SELECT 1 AS version_no, CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, CAST(NULL AS DOUBLE) AS s_acctbal FROM supplier
UNION ALL SELECT 2, CAST(s_suppkey AS BIGINT), upper(s_name), s_acctbal FROM supplier""")
def q_reload_versions(spark, base):
    """SNK-01 / SRC-05: a reload that reads the version before, with a column
    more and a wider key; both versions are read as the newest schema."""
    from tessera.sources import versions as W
    root = f"{checkpoint_dir(spark).rstrip('/')}/versions/{uuid.uuid4().hex[:12]}"
    s = Tables(spark, base).supplier
    W.reload(s.select(F.col("s_suppkey").cast("int").alias("s_suppkey"), "s_name"), root, "supplier")
    first = W.newest(spark, root, "supplier").select(F.col("s_suppkey").cast("long").alias("s_suppkey"), F.upper("s_name").alias("s_name"))
    W.reload(first.join(s.select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_acctbal"), "s_suppkey"), root, "supplier")
    names = [path.rpartition("/")[2] for path, complete in W.versions(spark, root, "supplier") if complete]
    number = F.when(F.col("version") == names[0], 1).otherwise(2)
    return W.all_versions(spark, root, "supplier").select(number.alias("version_no"), "s_suppkey", "s_name", "s_acctbal")

"""Scalar functions, predicates, NULL semantics and row-level business rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.plans import views as V
from tessera.plans.sqlfrag import given_name_sql
from tessera.plans.registry import Tables, query


@query("scalar_strings", sql="""SELECT p_partkey,
  upper(p_name) AS name_upper,
  trim('  ' || p_name || '  ') AS name_trim,
  trim(',' || p_brand || ',', ',') AS brand_trim_commas,
  p_name || nullif(p_type, 'SMALL') AS name_type_concat,
  concat_ws('|', p_name, nullif(p_type, 'SMALL'), p_brand) AS name_type_ws,
  regexp_replace(p_brand, '[^0-9]', '', 'g') AS brand_digits,
  md5(p_name || '|' || p_brand) AS name_md5,
  printf('part %s of %s', CAST(p_partkey AS VARCHAR), p_brand) AS label,
  substr(p_name, 1, 5) AS name_varchar5,
  coalesce(nullif(p_type, 'SMALL'), 'NONE') AS type_or_none
FROM part""")
def q_scalar_strings(spark, base):
    """STR-01..08, NUL-01/02, PRJ-03 (varchar(n) truncation as substring)."""
    p = Tables(spark, base).part
    t = F.nullif(F.col("p_type"), F.lit("SMALL"))
    return p.select(
        "p_partkey",
        F.upper("p_name").alias("name_upper"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit("  "))).alias("name_trim"),
        F.expr("trim(BOTH ',' FROM concat(',', p_brand, ','))").alias("brand_trim_commas"),
        F.concat(F.col("p_name"), t).alias("name_type_concat"),
        F.concat_ws("|", F.col("p_name"), t, F.col("p_brand")).alias("name_type_ws"),
        rules.digits_only("p_brand").alias("brand_digits"),
        F.md5(F.concat_ws("|", "p_name", "p_brand")).alias("name_md5"),
        F.format_string("part %s of %s", F.col("p_partkey").cast("string"), F.col("p_brand")).alias("label"),
        F.substring("p_name", 1, 5).alias("name_varchar5"),
        F.coalesce(t, F.lit("NONE")).alias("type_or_none"))


@query("scalar_dates", sql="""SELECT o_orderkey, d,
  CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m, CAST(day(d) AS INTEGER) AS dd,
  make_date(CAST(year(d) AS INTEGER), 2, 1) AS term1_start,
  CAST(d + 30 AS DATE) AS plus_30, CAST(d - 1 AS DATE) AS minus_1,
  CAST(date_diff('day', d, DATE '2000-01-01') AS INTEGER) AS days_to_2000,
  rpad(monthname(d), 9, ' ') AS month_name, upper(strftime(d, '%b')) AS short_month,
  CAST(CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS INTEGER) AS fy,
  CAST(date_diff('second', CAST(d AS TIMESTAMP), o_orderdate + INTERVAL 90 MINUTE) / 60 AS BIGINT) AS minutes_since_midnight
FROM (SELECT o_orderkey, o_orderdate, CAST(o_orderdate AS DATE) AS d FROM orders) x""")
def q_scalar_dates(spark, base):
    """DAT-01..05, STR-09, D-18: date parts, make_date, +/- days, datediff,
    padded month name, fiscal year, minutes between timestamps."""
    o = Tables(spark, base).orders.select("o_orderkey", "o_orderdate", F.to_date("o_orderdate").alias("d"))
    d = F.col("d")
    ts = F.col("o_orderdate").cast("timestamp")
    later = ts + F.expr("INTERVAL 90 MINUTES")
    return o.select(
        "o_orderkey", "d", F.year(d).alias("y"), F.month(d).alias("m"), F.dayofmonth(d).alias("dd"),
        F.make_date(F.year(d), F.lit(2), F.lit(1)).alias("term1_start"),
        F.date_add(d, 30).alias("plus_30"), F.date_sub(d, 1).alias("minus_1"),
        F.datediff(F.to_date(F.lit("2000-01-01")), d).alias("days_to_2000"),
        rules.month_name_padded(d).alias("month_name"), rules.short_month(d).alias("short_month"),
        rules.fiscal_year(d).alias("fy"),
        ((F.unix_seconds(later) - F.unix_seconds(d.cast("timestamp"))) / 60).cast("long")
        .alias("minutes_since_midnight"))


@query("scalar_math", sql="""SELECT l_orderkey, l_linenumber,
  CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS net_price,
  abs(l_quantity - 25) AS qty_dev,
  greatest(l_quantity, 25.0) AS qty_floor25,
  CAST(l_returnflag = 'R' AS INTEGER) + CAST(l_linestatus = 'F' AS INTEGER) AS flag_sum,
  CAST(round(CAST(l_tax AS DECIMAL(4,2)) * 100, 0) AS INTEGER) AS tax_pct
FROM lineitem""")
def q_scalar_math(spark, base):
    """MTH-01..03, CST-01: decimal round half-up, abs, greatest, bool->int."""
    li = Tables(spark, base).lineitem
    net = F.round(F.col("l_extendedprice").cast("decimal(15,2)") *
                  (F.lit(1).cast("decimal(1,0)") - F.col("l_discount").cast("decimal(4,2)")), 2).cast("double")
    return li.select(
        "l_orderkey", "l_linenumber", net.alias("net_price"),
        F.abs(F.col("l_quantity") - 25).alias("qty_dev"),
        F.greatest("l_quantity", F.lit(25.0)).alias("qty_floor25"),
        ((F.col("l_returnflag") == "R").cast("int") + (F.col("l_linestatus") == "F").cast("int")).alias("flag_sum"),
        F.round(F.col("l_tax").cast("decimal(4,2)") * 100, 0).cast("int").alias("tax_pct"))


@query("predicate_patterns", sql="""SELECT p_partkey,
  p_name LIKE '%ring%' AS like_ring,
  upper(p_name) LIKE '%R_NG%' AS like_wild,
  upper(p_name) LIKE '%RED%BOLT%' AS like_two_parts,
  p_type ILIKE 'eco%' AS ilike_eco,
  p_brand NOT ILIKE 'brand#1%' AS not_ilike_b1,
  p_size IN (1, 5, 10, 20) AS size_in
FROM part""")
def q_predicate_patterns(spark, base):
    """PRED-04..06: LIKE with % and _, ILIKE / NOT ILIKE, IN lists."""
    p = Tables(spark, base).part
    return p.select(
        "p_partkey",
        F.col("p_name").like("%ring%").alias("like_ring"),
        F.upper("p_name").like("%R_NG%").alias("like_wild"),
        F.upper("p_name").like("%RED%BOLT%").alias("like_two_parts"),
        F.col("p_type").ilike("eco%").alias("ilike_eco"),
        (~F.col("p_brand").ilike("brand#1%")).alias("not_ilike_b1"),
        F.col("p_size").isin(1, 5, 10, 20).alias("size_in"))


@query("null_semantics", sql="""SELECT p_partkey,
  a <> b AS three_valued_ne,
  coalesce(a, '') <> coalesce(b, '') AS coalesced_ne,
  a IS DISTINCT FROM b AS null_safe_ne,
  flag IS TRUE AS flag_is_true,
  flag IS FALSE AS flag_is_false,
  flag AS flag_raw
FROM (SELECT p_partkey, nullif(p_type, 'SMALL') AS a, nullif(p_type, 'ECONOMY') AS b,
             CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size > 25 END AS flag FROM part) x""")
def q_null_semantics(spark, base):
    """PRED-01..03: 3-valued <>, COALESCE'd <>, null-safe distinctness, IS TRUE/FALSE."""
    p = Tables(spark, base).part.select(
        "p_partkey", F.nullif("p_type", F.lit("SMALL")).alias("a"), F.nullif("p_type", F.lit("ECONOMY")).alias("b"),
        F.when(F.col("p_size") % 3 == 0, F.lit(None).cast("boolean")).otherwise(F.col("p_size") > 25).alias("flag"))
    a, b = F.col("a"), F.col("b")
    return p.select("p_partkey", (a != b).alias("three_valued_ne"),
                    (F.coalesce(a, F.lit("")) != F.coalesce(b, F.lit(""))).alias("coalesced_ne"),
                    (~a.eqNullSafe(b)).alias("null_safe_ne"),
                    rules.is_true("flag").alias("flag_is_true"), rules.is_false("flag").alias("flag_is_false"),
                    F.col("flag").alias("flag_raw"))


@query("person_rules", sql=f"""SELECT c_custkey,
  CASE WHEN birth IS NOT NULL THEN CAST(year(DATE '{V.DAY3}') - year(birth) AS INTEGER) END AS age,
  CASE WHEN mother IS TRUE AND father IS TRUE THEN 'BOTH DECEASED' WHEN mother IS TRUE THEN 'MOTHER DECEASED'
       WHEN father IS TRUE THEN 'FATHER DECEASED' ELSE 'NOT APPLICABLE' END AS orphan_status,
  {given_name_sql('first_name', 'other_names')} AS given_name,
  coalesce(country, 'UGANDA') AS nationality,
  coalesce(own_payroll, school_payroll) AS on_payroll,
  coalesce(upper(type_name), 'CONTINUING') AS enrolment_type,
  (CAST(coalesce(mother, FALSE) AS INTEGER) + CAST(coalesce(father, FALSE) AS INTEGER)
   + CAST(coalesce(c_acctbal > 9000, FALSE) AS INTEGER)) > 1 AS multiple_flags
FROM (SELECT c.c_custkey, c.c_acctbal,
        CASE WHEN c.c_custkey % 29 = 0 THEN NULL
             ELSE make_date(CAST(1950 + c.c_custkey % 50 AS INTEGER), CAST(1 + c.c_custkey % 12 AS INTEGER), CAST(1 + c.c_custkey % 28 AS INTEGER)) END AS birth,
        c.c_acctbal < 0 AS mother,
        CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE c.c_custkey % 5 = 0 END AS father,
        split_part(c.c_name, '#', 1) AS first_name,
        CASE WHEN c.c_custkey % 4 = 0 THEN NULL ELSE split_part(c.c_name, '#', 2) END AS other_names,
        CASE WHEN c.c_nationkey % 2 = 0 THEN n.n_name END AS country,
        CASE WHEN c.c_acctbal > 5000 THEN TRUE WHEN c.c_acctbal < 1000 THEN FALSE END AS own_payroll,
        c.c_mktsegment IN ('BUILDING', 'AUTOMOBILE') AS school_payroll,
        CASE c.c_mktsegment WHEN 'BUILDING' THEN 'new' WHEN 'MACHINERY' THEN 'Baseline' END AS type_name
      FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey) x""")
def q_person_rules(spark, base):
    """D-03, D-04, D-05, D-10, D-19, D-20, D-21 on learners/staff derived
    from customers (birth date, parents, names, country, payroll)."""
    t = Tables(spark, base)
    k = F.col("c_custkey")
    c = t.customer.join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    x = c.select(
        "c_custkey", "c_acctbal",
        F.when(k % 29 == 0, F.lit(None).cast("date"))
         .otherwise(F.make_date((1950 + k % 50).cast("int"), (1 + k % 12).cast("int"), (1 + k % 28).cast("int")))
         .alias("birth"),
        (F.col("c_acctbal") < 0).alias("mother"),
        F.when(k % 7 == 0, F.lit(None).cast("boolean")).otherwise(k % 5 == 0).alias("father"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.when(k % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.split_part("c_name", F.lit("#"), F.lit(2))).alias("other_names"),
        F.when(F.col("c_nationkey") % 2 == 0, F.col("n_name")).alias("country"),
        F.when(F.col("c_acctbal") > 5000, True).when(F.col("c_acctbal") < 1000, False).alias("own_payroll"),
        F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE").alias("school_payroll"),
        F.when(F.col("c_mktsegment") == "BUILDING", "new")
         .when(F.col("c_mktsegment") == "MACHINERY", "Baseline").alias("type_name"))
    return x.select(
        "c_custkey",
        F.when(F.col("birth").isNotNull(), rules.age_years("birth", F.to_date(F.lit(V.DAY3)))).alias("age"),
        rules.orphan_status("mother", "father").alias("orphan_status"),
        rules.given_name("first_name", "other_names").alias("given_name"),
        rules.nationality("country").alias("nationality"),
        F.coalesce("own_payroll", "school_payroll").alias("on_payroll"),
        rules.enrolment_type("type_name").alias("enrolment_type"),
        rules.multiple_flags("mother", "father", F.col("c_acctbal") > 9000).alias("multiple_flags"))


@query("school_rules", sql="""SELECT s_suppkey,
  coalesce(own_name, CASE WHEN govt IS TRUE THEN 'GOVT AIDED' WHEN govt IS FALSE THEN 'PRIVATE' END) AS ownership_keep_null,
  coalesce(own_name, CASE WHEN govt IS TRUE THEN 'GOVT AIDED' ELSE 'PRIVATE' END) AS ownership,
  CASE WHEN area IS NULL OR area < 0 OR area > 9999999999999.99 THEN NULL ELSE round(area, 2) END AS area_clean,
  CASE WHEN out_d IS NOT NULL AND in_d IS NOT NULL AND out_d <> in_d THEN TRUE ELSE FALSE END AS is_inter_district,
  CASE WHEN lang IS TRUE THEN 'LANGUAGE' WHEN sci IS TRUE THEN 'SCIENCE' ELSE 'ARTS' END AS subject_category
FROM (SELECT s_suppkey,
        CASE WHEN s_suppkey % 6 = 0 THEN 'COMMUNITY' END AS own_name,
        CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_acctbal > 4000 END AS govt,
        CASE WHEN s_suppkey % 13 = 0 THEN s_acctbal * 10000000000000.0 WHEN s_suppkey % 11 = 0 THEN NULL
             ELSE s_acctbal / 8 END AS area,
        CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_nationkey END AS out_d,
        (s_nationkey + s_suppkey % 2) % 25 AS in_d,
        s_suppkey % 4 = 0 AS lang,
        CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal > 0 END AS sci
      FROM supplier) x""")
def q_school_rules(spark, base):
    """D-08 (both NULL policies), D-12, D-13, D-17."""
    s = Tables(spark, base).supplier
    k = F.col("s_suppkey")
    x = s.select(
        "s_suppkey",
        F.when(k % 6 == 0, F.lit("COMMUNITY")).alias("own_name"),
        F.when(k % 5 == 0, F.lit(None).cast("boolean")).otherwise(F.col("s_acctbal") > 4000).alias("govt"),
        F.when(k % 13 == 0, F.col("s_acctbal") * 10000000000000.0)
         .when(k % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("s_acctbal") / 8).alias("area"),
        F.when(k % 9 == 0, F.lit(None).cast("int")).otherwise(F.col("s_nationkey")).alias("out_d"),
        ((F.col("s_nationkey") + k % 2) % 25).alias("in_d"),
        (k % 4 == 0).alias("lang"),
        F.when(k % 3 == 0, F.lit(None).cast("boolean")).otherwise(F.col("s_acctbal") > 0).alias("sci"))
    return x.select(
        "s_suppkey",
        rules.ownership("own_name", "govt", null_flag_is_private=False).alias("ownership_keep_null"),
        rules.ownership("own_name", "govt").alias("ownership"),
        rules.area_clean("area").alias("area_clean"),
        rules.inter_district("out_d", "in_d").alias("is_inter_district"),
        rules.subject_category("lang", "sci").alias("subject_category"))

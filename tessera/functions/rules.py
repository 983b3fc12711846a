"""Business column rules: pure ``Column -> Column`` functions.

Every rule is a JVM-side expression (no Python UDF), so it stays inside
whole-stage codegen wherever it is used. Inputs are column names or Columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the warehouse's outputs (texts and codes).
# ---------------------------------------------------------------------------
OPEN_END = "9999-12-31"
INITIAL_LOAD = "INITIAL_LOAD"
ATTRIBUTE_CHANGE = "ATTRIBUTE_CHANGE"
ATTRIBUTE_UPDATE = "Attribute update"
DEFAULT_NATIONALITY = "UGANDA"

COMPLETION_STATUS = {1: "COMPLETE", 2: "INCOMPLETE", 3: "UNDER CONSTRUCTION", 4: "PLANNED"}
USAGE_MODE = {1: "PERMANENT", 2: "TEMPORARY", 3: "SEMI-PERMANENT"}
CONDITION = {1: "GOOD", 2: "FAIR", 3: "POOR", 4: "DILAPIDATED"}
GENDER_USAGE = {1: "MALE", 2: "FEMALE", 3: "BOTH", 4: "NONE"}
USER_CATEGORY = {1: "TEACHERS ONLY", 2: "LEARNERS ONLY", 3: "BOTH"}
TRANSFER_STATUS = {1: "PENDING", 2: "APPROVED", 3: "REJECTED"}
TRANSFER_STATUS_ELSE = "UNKNOWN"

# Share of the total population in each school-age band.
AGE_BAND_SHARES = {
    "age_3_5": 0.055,
    "age_6": 0.018,
    "age_6_12": 0.125,
    "age_13_16": 0.068,
    "age_17_18": 0.032,
}

# Term start dates used by the enrolment fact (month, day).
TERM_START = {"TERM 1": (2, 1), "TERM 2": (6, 1), "TERM 3": (9, 1)}

# Fiscal quarters: July-September is Q1.
FISCAL_QUARTERS = {"Q1": (7, 8, 9), "Q2": (10, 11, 12), "Q3": (1, 2, 3), "Q4": (4, 5, 6)}
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_true(x) -> Column:
    """SQL ``x IS TRUE``: NULL counts as false."""
    return F.coalesce(_c(x), F.lit(False))


def is_false(x) -> Column:
    """SQL ``x IS FALSE``: NULL counts as false."""
    return F.coalesce(~_c(x), F.lit(False))


def code_map(x, mapping: dict, otherwise=None) -> Column:
    """Simple CASE over literal codes (D-11a..f)."""
    col = _c(x)
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(F.lit(otherwise)) if otherwise is not None else out


def digits_only(x) -> Column:
    return F.regexp_replace(_c(x), "[^0-9]", "")


def academic_year(name, fallback_date) -> Column:
    """D-01: digits of the year label as int, else the year of a date."""
    digits = F.nullif(digits_only(name), F.lit(""))
    return F.coalesce(digits.try_cast("int"), F.year(_c(fallback_date)))


def term_label(period) -> Column:
    """D-02: '1'/'2'/'3' -> 'TERM n'; 'term..' -> upper; anything else 'TERM 1'."""
    p = _c(period)
    return (F.when(p.isin("1", "2", "3"), F.concat(F.lit("TERM "), p))
             .when(p.ilike("TERM%"), F.upper(p))
             .otherwise(F.lit("TERM 1")))


def age_years(birth_date, as_of) -> Column:
    """D-03: calendar-year difference (not birthday exact)."""
    return F.year(_c(as_of)) - F.year(_c(birth_date))


def orphan_status(mother_dead, father_dead) -> Column:
    """D-04."""
    m, f = is_true(mother_dead), is_true(father_dead)
    return (F.when(m & f, F.lit("BOTH DECEASED"))
             .when(m, F.lit("MOTHER DECEASED"))
             .when(f, F.lit("FATHER DECEASED"))
             .otherwise(F.lit("NOT APPLICABLE")))


def multiple_flags(*flags) -> Column:
    """D-05: more than one of the (NULL = false) flags is set."""
    total = None
    for fl in flags:
        term = is_true(fl).cast("int")
        total = term if total is None else total + term
    return total > 1


def sex_composition(has_female, has_male) -> Column:
    """D-06: null-safe composition from two admission flags."""
    f, m = is_true(has_female), is_true(has_male)
    return (F.when(f & m, F.lit("MIXED"))
             .when(f & ~m, F.lit("FEMALES ONLY"))
             .when(m & ~f, F.lit("MALES ONLY")))


def boarding_status(general: list[tuple], residential: list[tuple] | None = None) -> Column:
    """D-07: boarding label from subtype rows.

    ``general`` / ``residential`` are lists of ``(present, day, boarders)``
    column triples, one per subtype table, in priority order. A subtype row is
    present when its join key is not NULL; flags are taken from the first
    present table (COALESCE order).
    """
    def branch(triples, labels):
        present = None
        for p, _, _ in triples:
            present = _c(p).isNotNull() if present is None else present | _c(p).isNotNull()
        day = F.coalesce(*[_c(d) for _, d, _ in triples])
        board = F.coalesce(*[_c(b) for _, _, b in triples])
        value = (F.when(is_true(day) & is_false(board), F.lit(labels[0]))
                  .when(is_false(day) & is_true(board), F.lit(labels[1]))
                  .when(is_true(day) & is_true(board), F.lit(labels[2])))
        return present, value

    p1, v1 = branch(general, ("DAY SCHOOL", "FULLY BOARDING", "DAY AND BOARDING"))
    out = F.when(p1, v1)
    if residential:
        p2, v2 = branch(residential, ("NON RESIDENTIAL", "RESIDENTIAL", "BOTH RES/NON"))
        out = out.when(p2, v2)
    return out


def ownership(lookup_name, govt_flag, null_flag_is_private: bool = True) -> Column:
    """D-08: lookup name, else the government flag."""
    g = _c(govt_flag)
    if null_flag_is_private:
        derived = F.when(is_true(g), F.lit("GOVT AIDED")).otherwise(F.lit("PRIVATE"))
    else:
        derived = F.when(is_true(g), F.lit("GOVT AIDED")).when(is_false(g), F.lit("PRIVATE"))
    return F.coalesce(_c(lookup_name), derived)


def enrolment_type(lookup_name, default: str = "CONTINUING") -> Column:
    """D-10."""
    return F.coalesce(F.upper(_c(lookup_name)), F.lit(default))


def area_clean(area, upper: float = 9999999999999.99) -> Column:
    """D-12: NULL when missing, negative or too large; else rounded to 2 dp."""
    a = _c(area)
    return F.when(a.isNull() | (a < 0) | (a > upper), F.lit(None).cast("double")) \
            .otherwise(F.round(a, 2))


def inter_district(out_district, in_district) -> Column:
    """D-13: both districts known and different."""
    o, i = _c(out_district), _c(in_district)
    return F.when(o.isNotNull() & i.isNotNull() & (o != i), F.lit(True)).otherwise(F.lit(False))


def discipline(science_count, total_count) -> Column:
    """D-16: SCIENCE / ARTS / BOTH; NULL when there are no subjects."""
    s, t = _c(science_count), _c(total_count)
    return (F.when(t.isNull() | (t == 0), F.lit(None).cast("string"))
             .when(s == t, F.lit("SCIENCE"))
             .when(s == 0, F.lit("ARTS"))
             .otherwise(F.lit("BOTH")))


def subject_category(is_language, is_science) -> Column:
    """D-17."""
    return (F.when(is_true(is_language), F.lit("LANGUAGE"))
             .when(is_true(is_science), F.lit("SCIENCE"))
             .otherwise(F.lit("ARTS")))


def fiscal_year(d) -> Column:
    """D-18: July starts the next fiscal year."""
    d = _c(d)
    return F.when(F.month(d) >= 7, F.year(d) + 1).otherwise(F.year(d))


def fiscal_quarter(d) -> Column:
    d = _c(d)
    out = None
    for q, months in FISCAL_QUARTERS.items():
        cond = F.month(d).isin(*months)
        out = F.when(cond, F.lit(q)) if out is None else out.when(cond, F.lit(q))
    return out


def month_name_padded(d) -> Column:
    """STR-09: full month name blank-padded to 9 characters."""
    return F.rpad(F.date_format(_c(d), "MMMM"), 9, " ")


def short_month(d) -> Column:
    return F.upper(F.date_format(_c(d), "MMM"))


def given_name(first, other) -> Column:
    """D-19."""
    return F.trim(F.concat(F.coalesce(_c(first), F.lit("")), F.lit(" "),
                           F.coalesce(_c(other), F.lit(""))))


def nationality(country) -> Column:
    """D-20."""
    return F.coalesce(_c(country), F.lit(DEFAULT_NATIONALITY))


def school_age_denominator(level, age_3_5, age_6_12, age_13_16, age_17_18) -> Column:
    """D-26: population of official school age for a level name."""
    lv = _c(level)
    return (F.when(lv.ilike("%PRE%PRIMARY%"), _c(age_3_5))
             .when(lv.ilike("%PRIMARY%"), _c(age_6_12))
             .when(lv.ilike("%SECONDARY%"), _c(age_13_16) + _c(age_17_18)))


def rate(numerator, denominator, scale: int = 100, digits: int = 2) -> Column:
    """D-27/D-28: round(n / d * scale, digits) when d > 0, else NULL.

    Computed on exact decimals (half-up on the true ratio, as NUMERIC does),
    returned as double.
    """
    # Scale in integers, then divide decimal(20,0) values: Spark keeps 18
    # decimals for that quotient, so the final round is the only rounding.
    n = (_c(numerator).cast("long") * F.lit(int(scale))).cast("decimal(20,0)")
    d = _c(denominator).cast("decimal(20,0)")
    return F.when(d > 0, F.round(n / d, digits).cast("double"))


def parity(female_rate, male_rate, digits: int = 4) -> Column:
    """D-29/D-30: female / male, NULL unless the male value is > 0.

    Inputs are 2-decimal rates; the division runs on decimals.
    """
    fr = F.coalesce(_c(female_rate), F.lit(0.0)).cast("decimal(20,2)")
    mr = _c(male_rate).cast("decimal(20,2)")
    return F.when(mr > 0, F.round(fr / mr, digits).cast("double"))


def term_start_date(year, term) -> Column:
    """CAL-01: fixed start date of a term label."""
    t = _c(term)
    out = None
    for label, (m, d) in TERM_START.items():
        v = F.make_date(_c(year), F.lit(m), F.lit(d))
        out = F.when(t == label, v) if out is None else out.when(t == label, v)
    return out


def change_hash(cols: list, defaults: dict | None = None) -> Column:
    """D-22: md5 over '|'-joined, NULL-defaulted text of the tracked columns."""
    defaults = defaults or {}
    parts = [F.coalesce(_c(c).cast("string"), F.lit(defaults.get(c, "") if isinstance(c, str) else ""))
             for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def any_true(*flags) -> Column:
    """D-32: at least one of the boolean columns is true (NULL counts as false)."""
    out = F.lit(False)
    for f in flags:
        out = out | F.coalesce(_c(f), F.lit(False))
    return out

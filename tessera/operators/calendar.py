"""Calendars: the date dimension and term calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import rules
from tessera.operators.dedupe import pick_one


def date_dim(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """M-DATE: one row per day between the bounds (one bounds row).

    The day count is the calendar span (5,844 rows for 16 years), not a data
    volume, so the single generating task is bounded.
    """
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end),
                                              F.expr("interval 1 day"))).alias("system_date"))
    d = F.col("system_date")
    return days.select(
        d,
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        rules.month_name_padded(d).alias("month_name"),
        rules.short_month(d).alias("short_month"),
        F.year(d).alias("year"),
        rules.fiscal_year(d).alias("FY"),
        rules.fiscal_quarter(d).alias("Quarter"),
    )


def year_bounds(df: DataFrame, date_col: str) -> DataFrame:
    """Whole calendar years spanning a date column (Jan 1 .. Dec 31)."""
    return df.agg(F.make_date(F.year(F.min(date_col)), F.lit(1), F.lit(1)).alias("start_date"),
                  F.make_date(F.year(F.max(date_col)), F.lit(12), F.lit(31)).alias("end_date"))


def term_dates(flat: DataFrame, year: str = "academic_year", term: str = "term") -> DataFrame:
    """CAL-01: distinct (year, term) with the fixed term start date."""
    return (flat.select(year, term).distinct()
                .withColumn("term_start_date", rules.term_start_date(F.col(year), F.col(term))))


def term_calendar(periods: DataFrame, keys: list[str], order) -> DataFrame:
    """CAL-02: one calendar row per (year, term), chosen under ``order``."""
    return pick_one(periods, keys, order)


def year_of(d) -> Column:
    return F.year(F.col(d) if isinstance(d, str) else d)

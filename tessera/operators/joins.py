"""Join helpers: fan-out over calendars without a join, OR-join split, sides
joined by their rows instead of the size of their files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Up to this many rows of a few fixed-width columns (some 100 bytes each as a
# hash table) a stored table may be broadcast.
BROADCAST_ROWS = 500_000
# With text columns a row takes some 550 bytes: 240,000 of them were 131 MB.
BROADCAST_WIDE_ROWS = 50_000


def sized(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table as one side of a join: broadcast up to ``limit`` rows,
    sort-merged beyond.

    Left to itself Spark judges a stored table by its files. Encoded and
    compressed columns with many repeats are a small part of what their rows
    take as a hash table, so tables of millions of rows pass for small ones and
    are gathered by the driver. The rows come from the file footers; the hint
    stays with a projection, filter or aggregate of the table.
    """
    return F.broadcast(table) if table.count() <= limit else table.hint("merge")


def expand_over(df: DataFrame, table: DataFrame) -> DataFrame:
    """Give every row of ``df`` one copy per row of ``table``, a calendar or
    code list.

    This is the row-times-term grain of the staff facts (``JOIN .. ON TRUE``).
    The list becomes one array, a scalar subquery of the same plan, which each
    row explodes: no join, no shuffle of ``df``, and no limit on the list. An
    empty list gives no rows.
    """
    cols = table.columns
    terms = table.agg(F.collect_list(F.struct(*cols))).scalar()
    return (df.withColumn("__term", F.explode(terms))
              .select(*df.columns, *[F.col(f"__term.{c}").alias(c) for c in cols]))


def or_join_terms(df: DataFrame, calendar: DataFrame, df_school: str, cal_school: str) -> DataFrame:
    """J-03: ``ON (cal.school IS NULL OR cal.school = df.school)`` without a
    nested-loop join: global rows are expanded, school rows equi-joined."""
    global_rows = calendar.where(F.col(cal_school).isNull())
    specific = calendar.where(F.col(cal_school).isNotNull())
    a = expand_over(df, global_rows)
    b = df.join(specific, df[df_school] == specific[cal_school], "inner") \
          .select(*df.columns, *[specific[c] for c in calendar.columns])
    return a.unionByName(b)

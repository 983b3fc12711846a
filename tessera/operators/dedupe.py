"""One row per key (DISTINCT ON) without a window over the key.

``pick_one`` reduces each key to a single row with ``min``/``max`` over a
struct of (ordering columns, payload). That is an ordinary aggregate, so
Spark runs it as a partial (map-side) aggregate followed by a final one: a
key holding a third of all rows is cut down to one row per input partition
before the shuffle, instead of landing whole in one window task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _norm(order) -> list[tuple[str, bool, bool]]:
    """Normalise ``order`` to (column, descending, nulls_last) triples.

    Accepted items: ``"col"`` (ascending, nulls last as in PostgreSQL),
    ``("col", "desc")`` (descending, nulls last), or
    ``("col", "asc"|"desc", "first"|"last")``.
    """
    out = []
    for item in order:
        if isinstance(item, str):
            out.append((item, False, True))
            continue
        name, direction = item[0], item[1].lower()
        nulls = item[2].lower() if len(item) > 2 else "last"
        out.append((name, direction == "desc", nulls == "last"))
    return out


def pick_one(df: DataFrame, keys: list[str], order, columns: list[str] | None = None) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (ties: give a total order).

    Equivalent to ``row_number() over (partition by keys order by order) = 1``.
    All order items must share one direction; each may choose its NULL place.
    """
    columns = columns or [c for c in df.columns if c not in keys]
    return pick_each(df, keys, {"__best": (order, columns)}).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in columns])


def pick_each(df: DataFrame, keys: list[str], picks: dict[str, tuple]) -> DataFrame:
    """Several first rows per ``keys``, each under its own order, in one
    aggregate: ``picks`` maps the name of a struct column to (order, columns)."""
    return df.groupBy(*keys).agg(*[_first(order, columns).alias(name) for name, (order, columns) in picks.items()])


def _first(order, columns: list[str]) -> Column:
    spec = _norm(order)
    directions = {desc for _, desc, _ in spec}
    if len(directions) != 1:
        raise ValueError("pick_one needs one direction for all order columns")
    descending = directions.pop()
    # Under max() a NULL field sorts lowest; under min() also lowest. Prefix an
    # is-null flag where the NULL place must be flipped.
    fields: list[Column] = []
    for i, (name, desc, nulls_last) in enumerate(spec):
        null_low = (desc and nulls_last) or (not desc and not nulls_last)
        if not null_low:
            # max() with NULLs first, or min() with NULLs last: a leading
            # is-null flag moves NULLs to the chosen end.
            fields.append(F.col(name).isNull().alias(f"__n{i}"))
        fields.append(F.col(name).alias(f"__o{i}"))
    payload = [F.col(c).alias(c) for c in columns]
    packed = F.struct(*fields, *payload)
    return F.max(packed) if descending else F.min(packed)


def pick_one_window(df: DataFrame, keys: list[str], order_cols: list[Column]) -> DataFrame:
    """Window form for mixed directions (one window task per key)."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def unique_or_null(df: DataFrame, code: str) -> DataFrame:
    """FLT-06: drop every row whose non-NULL ``code`` occurs more than once.

    Counting per code is a partial aggregate (one row per code leaves each
    map task); the left join lets NULL codes through untouched.
    """
    counts = (df.where(F.col(code).isNotNull())
                .groupBy(code).agg(F.count(F.lit(1)).alias("__n")))
    return (df.join(counts, code, "left")
              .where(F.col(code).isNull() | (F.col("__n") == 1))
              .select(*df.columns))

"""Compare a Spark query with its DuckDB oracle SQL (rows, columns, values).

Mirrors the driver's check: columns sorted by name, row multiset compared
order-insensitively. Values are compared exactly after a light
normalisation (numpy scalars to Python, NaN/NaT to None).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(base, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except Exception:
            pass
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(rows, key=_key)


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    types = {names[i]: str(rel.types[i]) for i in range(len(names))}
    return [names[i] for i in order], sorted(rows, key=_key), types


def compare(spark, name, builder, sql, base, verbose=True):
    df = builder(spark, base)
    scols, srows = spark_rows(df)
    con = duck(base)
    dcols, drows, dtypes = duck_rows(con, sql)
    problems = []
    if scols != dcols:
        problems.append(f"columns differ: spark={scols} duck={dcols}")
    if len(srows) != len(drows):
        problems.append(f"row count spark={len(srows)} duck={len(drows)}")
    elif srows != drows:
        diff = [(a, b) for a, b in zip(srows, drows) if a != b][:3]
        problems.append(f"values differ, first: {diff}")
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if verbose and problems:
        print(name, "spark types", stypes, "duck types", dtypes, file=sys.stderr)
    return problems, len(srows)

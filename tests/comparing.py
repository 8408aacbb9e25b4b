"""Compare Spark and DuckDB results as multisets of rows with columns in name order."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

TABLES = "region nation customer supplier part orders lineitem".split()


def open_oracle(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _value(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, (int, float, Decimal)):
        if isinstance(v, float) and math.isnan(v):
            return "NaN"
        return float(v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return v


def canonical(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_value(r[i]) for i in order) for r in rows)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def oracle_result(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


def difference(df, con, sql) -> str | None:
    (c1, r1), (c2, r2) = spark_result(df), oracle_result(con, sql)
    if c1 != c2:
        return f"columns {c1} != {c2}"
    if r1 != r2:
        left, right = list((r1 - r2).items())[:3], list((r2 - r1).items())[:3]
        return f"{sum(r1.values())} vs {sum(r2.values())} rows of {c1}; spark only {left}; oracle only {right}"
    return None

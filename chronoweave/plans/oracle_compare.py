"""Compare a Spark query with its DuckDB oracle (used by tests and by hand).

Rows are compared as multisets: values are normalised (floats rounded to 6
significant digits, NaN kept as a token, lists/structs recursively) before
sorting, then compared exactly.
"""
from __future__ import annotations

import math
from decimal import Decimal

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        if math.isinf(v):
            return ("~inf", v > 0)
        if v == 0:
            return 0.0
        return float(f"{v:.6g}")
    if isinstance(v, Decimal):
        return _norm(float(v))
    if isinstance(v, int):
        return v
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    rows = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(df, con, sql):
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    key = repr
    a, b = sorted(sr, key=key), sorted(dr, key=key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first mismatch:\n spark={x}\n duck ={y}"
    return True, f"{len(sr)} rows match"

"""Compare a query with its SQL: same columns, same rows in any order."""

import datetime
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, dict):
        return {str(k): plain(x) for k, x in v.items()}
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


def differences(df, con, sql):
    """None if equal, else what differs."""
    got, cur = df.collect(), con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    a, b = rows(df.columns, got), rows(names, want)
    if a != b:
        x, y = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
        return f"{len(a)} and {len(b)} rows; only here {x}; only SQL {y}"
    return None if a else "no rows"

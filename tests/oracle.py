"""Rows of a query and of its SQL, compared without regard to order."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def canonical(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, bool):
        return v
    return str(v) if not isinstance(v, (int, type(None))) else v


def compare(spark, con, sf_dir, query, sql) -> str | None:
    df = query(spark, sf_dir)
    got = df.collect()
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    at = [names.index(n) for n in order]
    a = sorted((tuple(canonical(r[n]) for n in order) for r in got), key=repr)
    b = sorted((tuple(canonical(r[i]) for i in at) for r in want), key=repr)
    if a != b:
        only = [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2]
        return f"{len(a)} rows, {len(b)} wanted; only here {only[0]}, only there {only[1]}"
    return None

"""Run a query in Spark and its SQL in DuckDB, and compare the results as multisets."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return ("nan",) if v != v else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def compare(spark, con, sf_dir: str, fn, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    mine = Counter(tuple(_cell(v) for v in r) for r in df.select(*names).collect())
    rel = con.execute(sql)
    theirs_names = [d[0] for d in rel.description]
    if sorted(theirs_names) != names:
        return f"columns {names} != {sorted(theirs_names)}"
    at = [theirs_names.index(n) for n in names]
    theirs = Counter(tuple(_cell(r[i]) for i in at) for r in rel.fetchall())
    if mine == theirs:
        return None
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"rows {sum(mine.values())} vs {sum(theirs.values())}; "
        f"only spark {sum(only_mine.values())} {list(only_mine)[:3]}; "
        f"only oracle {sum(only_theirs.values())} {list(only_theirs)[:3]}"
    )

"""Run a registered query and its SQL twin, and compare them as multisets."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = "documents pages benchmark labels conversations events".split()


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v


def twin(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    r = con.sql(sql)
    order = sorted(range(len(r.columns)), key=lambda i: r.columns[i])
    return sorted(r.columns), Counter(tuple(plain(x[i]) for i in order) for x in r.fetchall())


def rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[n]) for n in names) for r in df.collect())

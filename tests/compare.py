"""Spark results against DuckDB SQL, as multisets of rows."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[c]) for c in names) for r in df.collect())


def rows_of_duckdb(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], Counter(tuple(plain(r[k]) for k in order) for r in found.fetchall())

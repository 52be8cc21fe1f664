"""Runs a query on Spark and its SQL on DuckDB and compares rows."""

import math
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(f"{sf_dir}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}/*.parquet')" if p.is_dir() else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, name: str, f, sql: str, sf_dir: str) -> list:
    df = f(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = oracle(sf_dir).execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns), (name, sorted(names), sorted(df.columns))
    want = rows(names, rel.fetchall())
    assert len(got) == len(want), (name, len(got), len(want), got[:2], want[:2])
    return [(g, w) for g, w in zip(got, want) if g != w]

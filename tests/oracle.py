"""Spark rows against the rows of the same query's SQL in DuckDB."""

from __future__ import annotations

import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, (str, bytes, bool, int)):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)) and not hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


def rows(columns: list[str], found) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in found), key=lambda r: tuple((x is None, str(x)) for x in r))


def same(spark, con, query, sql: str, sf_dir: str) -> None:
    df = query(spark, sf_dir)
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, got.fetchall())

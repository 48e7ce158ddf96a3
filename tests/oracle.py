"""Run a query's DuckDB text on the same tables and compare rows, order aside."""

import math
import os

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str = SF):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v if isinstance(v, (int, str)) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([plain(r[i]) for i in order]) for r in rows)


def check(spark, name, query, sql, sf_dir=SF):
    df = query(spark, sf_dir)
    cur = connect(sf_dir).execute(sql)
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns), name
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall()), name

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from shelfspark.session import local_session

    s = local_session(4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)


def oracle_rows(con, sql):
    r = con.sql(sql)
    names = sorted(r.columns)
    at = [r.columns.index(c) for c in names]
    return names, sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=str)

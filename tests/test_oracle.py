"""Every query against its SQL, over the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from tidemark.plans.fact_queries import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{files}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return v if v is None or isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    assert rows
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = sorted([tuple(plain(r[columns.index(c)]) for c in order) for r in found.fetchall()], key=repr)
    assert sorted([tuple(plain(r[c]) for c in order) for r in rows], key=repr) == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_needs_the_text_operators():
    for path in glob.glob("tidemark/**/*.py", recursive=True):
        if "/llm/" not in path:
            with open(path) as f:
                assert "tidemark.llm" not in f.read(), path

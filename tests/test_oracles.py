"""Every registered query equals its DuckDB oracle (the driver's gate),
run here at sf0.01 where hourly batches can be complete."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle_or_is_rows_only():
    q, o = set(E.queries()) - set(E.LLM_QUERIES), set(E.oracle_sql()) - set(E.LLM_ORACLE_SQL)
    assert o <= q
    assert q - o == E.ROWS_ONLY


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    for c, t in df.dtypes:
        assert SPARK_TO_DUCK.get(t, t) == duck_types[c], (c, t, duck_types[c])
    perm = [rel.columns.index(c) for c in df.columns]
    expected = sorted(tuple(_norm(r[i]) for i in perm) for r in rel.fetchall())
    assert sorted(tuple(_norm(x) for x in r) for r in rows) == expected


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["city", "n"] and len(rows) == 5 and all(r.n == 30 for r in rows)

"""Every registered query against its SQL oracle at sf0.001 (DuckDB)."""

from __future__ import annotations

import math
import os
from collections import Counter

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from statforge.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}") if v != 0 else 0.0
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    cols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(exp)
    assert _bag(df.columns, got) == _bag(cols, exp)


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert df.columns == ["cluster", "n"] and sum(r["n"] for r in rows) == 6000

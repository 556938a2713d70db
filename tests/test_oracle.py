"""Every registered query against its DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMOKE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


def _norm(rows):
    def cell(v):
        if isinstance(v, float):
            return round(v, 6)
        if isinstance(v, (dt.date, dt.datetime)):
            return v.isoformat()
        return v
    return sorted((tuple(cell(v) for v in r) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    optional = set(E.LLM_QUERIES)  # tested with the folder they are in
    assert set(E.oracle_sql()) - optional == set(E.queries()) - optional


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["product_id", "product_name", "department_name", "aisle"]
    assert df.count() > 0


@pytest.mark.skipif(not os.path.isdir(SF_SMOKE), reason="test tables missing")
@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMOKE)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [df.columns.index(c) for c in rel.columns]
    got = [tuple(r[i] for i in order) for r in df.collect()]
    assert _norm(got) == _norm(rel.fetchall())


def test_entry_module_imports_without_a_session():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as E; assert len(E.queries()) >= len(E.oracle_sql()) > 40"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)

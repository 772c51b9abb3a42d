"""Every registered query against its DuckDB twin on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import duckdb
import pytest

from conftest import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from check_oracle import TABLES, rows_of  # noqa: E402

import __spark_entry__ as E  # noqa: E402

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    # the training-data queries (opN_, pipeline) have SQL only where it can state them
    own = {q for q in QUERIES if q != "pipeline" and not q.startswith("op")}
    assert own <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(q for q in ORACLE if not q.startswith("op")))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_of(cols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["cut", "word", "n"]
    assert df.count() > 0

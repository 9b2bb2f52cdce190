"""Every registered query against its DuckDB oracle on the smallest tables."""


import duckdb
import pytest

from conftest import SF001

import __spark_entry__ as E
from tokenweave.plans.catalog import QUERIES
from tokenweave.plans.oracle import ORACLE_SQL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return [cols[i].lower() for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.sql(E.oracle_sql()[name])
    want_cols, want = _rows(res.columns, res.fetchall())
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want


def test_every_query_has_oracle_or_is_listed():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())
    assert set(QUERIES) - set(ORACLE_SQL) == {"generate_text", "bpe_generate_text", "learn_bpe_vocabulary"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and sum(r.n_tokens for r in rows) == 496_092  # bytes and one end-of-text a document

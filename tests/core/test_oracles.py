"""Every core query against its SQL, run by the other engine on the same files."""

from __future__ import annotations

import duckdb
import pytest

from tidemark.plans.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def engine(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, engine, sf_dir, name):
    df, rel = QUERIES[name](spark, sf_dir), engine.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    pick = lambda columns, rows: sorted(tuple(map(repr, (r[columns.index(c)] for c in sorted(columns)))) for r in rows)
    assert pick(df.columns, [tuple(r) for r in df.collect()]) == pick(rel.columns, rel.fetchall())

"""Every query against its SQL."""

import duckdb
import pytest
from conftest import SMALL

from folioforge.plans import registry, rules

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(rules.QUERIES))
def test_query(spark, db, name):
    got = registry.QUERIES[name](spark, SMALL)
    columns = sorted(got.columns)
    rows = sorted(repr(tuple(r)) for r in got.select(*columns).collect())
    assert rows
    if name in registry.ORACLES:
        want = db.sql(f"SELECT {', '.join(columns)} FROM ({registry.ORACLES[name]})").fetchall()
        assert rows == sorted(map(repr, want))

"""Queries of the corpus operators against their SQL, on whole tables."""

import duckdb
import pytest
from conftest import MEDIUM, SMALL

from folioforge.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("where", [SMALL, MEDIUM])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name, where):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{where}/{t}.parquet'")
    got = QUERIES[name](spark, where)
    columns = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})")
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == sorted(map(repr, want.fetchall()))

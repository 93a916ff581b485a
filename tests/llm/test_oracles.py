from __future__ import annotations

import duckdb
import pytest

from eventmart.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(names)
    want = sorted(cur.fetchall(), key=str)
    assert want and sorted(map(tuple, got.select(*names).collect()), key=str) == want

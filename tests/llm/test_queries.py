"""The registered queries against their DuckDB oracles on the generated tables."""

from __future__ import annotations

import duckdb
import pytest

from lodgepole.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    rel = con.execute(ORACLE[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    expected = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str)
    rows = sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str)
    assert len(rows) == len(expected) > 0
    assert rows == expected

"""Every registered query against its DuckDB oracle on the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from lodgepole.registry import QUERIES
from tools.oracle_check import TABLES, norm

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF).toPandas()
    o = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert norm(s) == norm(o)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["year", "month"] and df.count() > 0


def test_the_data_can_fail(spark):
    """A de-duplication or an ingest step that does nothing would show."""
    duplicates = {r.table_name: r.duplicate_rows for r in E.queries()["duplicate_profile"](spark, SF).collect()}
    assert duplicates["bookings"] > 0 and duplicates["user_viewing"] > 0
    listings = E.queries()["curated_apartments"](spark, SF).count()
    assert listings < spark.read.parquet(f"{SF}/part.parquet").count()
    nulls = {(r.table_name, r.column_name): r.null_count for r in E.queries()["null_profile"](spark, SF).collect()}
    assert nulls["bookings", "user_id"] > 0 and nulls["apartments", "price"] > 0

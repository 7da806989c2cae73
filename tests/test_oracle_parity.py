"""Every registered query against its DuckDB oracle (the driver's check, on sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from fjord.plans.oracle import ORACLE
from fjord.plans.queries import QUERIES
from fjord.sources.tables import TABLES
from tools.oracle_check import digest
from tests.conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "daily_amount_rank" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]

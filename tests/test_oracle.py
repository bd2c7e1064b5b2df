"""Every registered query against its DuckDB oracle (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from fleetpulse.sources.tables import TABLES, table_path
from scripts.oracle_check import digest
from tests.conftest import SF001

# the training-data queries have tests of their own
KEYS = sorted(set(E.queries()) - set(E.LLM_QUERIES))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{table_path(SF001, t)}'")
    return c


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "vehicleId" in df.columns


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF001).toPandas()
    want = con.execute(E.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)

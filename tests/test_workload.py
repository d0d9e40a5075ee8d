"""Every check query against its SQL, on the smallest tables."""

import pytest

duckdb = pytest.importorskip("duckdb")

from workload.compare import connect, differences  # noqa: E402
from workload.queries import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name in ORACLES:
        assert differences(got, con.execute(ORACLES[name]).df()) is None


def test_entry(spark):
    import __spark_entry__ as contract
    assert contract.entry(spark).columns == ["req_id", "time", "temperature_2m", "relative_humidity_2m"]
    assert set(contract.oracle_sql()) <= set(contract.queries())

"""Every registered query against its SQL oracle, on the smallest scale."""

import pytest

from tests.compare import compare, duck
from tests.conftest import SF_DIR
from tidemark.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, con, name):
    ok, message, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert ok, message
    assert "types" not in message, message


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == [
        "order_date", "num_orders", "gross_revenue", "total_refunds", "net_revenue",
    ]
    assert set(contract.queries()) >= set(contract.oracle_sql())

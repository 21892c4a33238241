"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from shopflow.plans.catalogue import QUERIES
from shopflow.plans.oracle import SQL
from tests.conftest import SF_SMALL
from tests.oracle_util import compare, duck

BATCH = sorted(k for k in QUERIES if not k.startswith("stream_"))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", BATCH)
def test_batch_query_matches_oracle(spark, con, key):
    compare(QUERIES[key](spark, SF_SMALL), con, SQL[key])


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k.startswith("stream_")))
def test_stream_matches_batch_oracle(spark, con, key):
    compare(QUERIES[key](spark, SF_SMALL), con, SQL[key])


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["category_id", "click_count", "order_count", "pay_count"]

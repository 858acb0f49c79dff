"""Every query with an oracle gives DuckDB's rows, columns and types."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as driver
from feedmill.plans import catalog, oracle

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")

# The training-data queries have tests of their own.
QUERIES, ORACLE = catalog.registered(), oracle.ORACLE
MODEL_QUERIES = {
    "daily_candidates",
    "evaluate",
    "grid",
    "recommend_for_all",
    "shard_kmeans",
    "top_k_products",
    "train_recommend",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_driver_lists_them_all():
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_only_model_queries_lack_an_oracle():
    assert set(QUERIES) - set(ORACLE) == MODEL_QUERIES
    assert not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == []


def test_entry_gives_rows(spark):
    assert driver.entry(spark).limit(1).count() == 1

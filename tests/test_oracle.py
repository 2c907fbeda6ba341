"""Every query that SQL can express gives the same rows as its SQL in another engine."""

import pytest

from conftest import SF
from rosterline.plans import ORACLE, QUERIES
from tools.check_queries import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    verdict = compare(QUERIES[name](spark, SF), con.sql(ORACLE[name]))
    spark.catalog.clearCache()
    assert verdict.startswith("ok"), verdict


def test_sql_belongs_to_queries():
    assert set(ORACLE) <= set(QUERIES)

"""Every registered query against its SQL, on the whole test tables."""

import pytest
from compare import assert_same

from hylle import suite

suite.load()


@pytest.mark.parametrize("name", sorted(suite.CHECKS))
def test_query_agrees_with_sql(name, spark, duck, sf_dir):
    assert_same(suite.QUERIES[name](spark, sf_dir), duck, suite.CHECKS[name])


@pytest.mark.parametrize("name", sorted(set(suite.QUERIES) - set(suite.CHECKS)))
def test_query_without_sql_gives_rows(name, spark, sf_dir):
    assert suite.QUERIES[name](spark, sf_dir).count() > 0

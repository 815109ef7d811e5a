"""Every registered query against its SQL in DuckDB, on whole tables."""

import pytest

from compare import connect, differences
from registry.oracles import ORACLES
from registry.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    problems, _ = differences(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert not problems, "\n".join(problems)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).limit(5).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)

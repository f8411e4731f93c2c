"""Every registered query against its DuckDB oracle on the smallest scale."""

import pytest

from __spark_entry__ import entry
from hitlens.plans.oracles import oracle_sql
from hitlens.plans.registry import queries
from scripts.check_oracles import compare, duck
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    problems, *_ = compare(spark, con, SF_SMALL, name, queries()[name], oracle_sql()[name])
    assert not problems, problems


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["country", "begin_area", "streams", "n"]
    assert df.count() > 0

"""Queries against their SQL twins, and what the registered ones are."""

import oracle
import pytest
from tillroll.llm.catalog import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(sf_small):
    return oracle.connect(sf_small)


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_sql(spark, sf_small, duck, name):
    names, rows = oracle.actual(QUERIES[name](spark, sf_small))
    expected_names, expected_rows = oracle.expected(duck, ORACLE_SQL[name])
    assert names == expected_names
    assert rows == expected_rows
    assert sum(rows.values()) > 0

"""Every query against its SQL twin, schema and rows, at the scale of the gate."""

import oracle
import pytest
from tillroll.plans.catalog import QUERIES
from tillroll.plans.oracle import ORACLE_SQL


@pytest.fixture(scope="module")
def duck(sf_gate):
    return oracle.connect(sf_gate)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_gate, duck, name):
    names, rows = oracle.actual(QUERIES[name](spark, sf_gate))
    expected_names, expected_rows = oracle.expected(duck, ORACLE_SQL[name])
    assert names == expected_names
    assert sum(rows.values()) == sum(expected_rows.values()) > 0
    assert rows == expected_rows

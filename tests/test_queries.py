"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry
from tallyloom.plans.oracles import ORACLES
from tallyloom.plans.registry import QUERIES
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def connection(tables):
    return connect(tables)


# Newton's method needs a linear solver; test_win_model.py holds it against a dense fit.
WITHOUT_SQL = {"win_model_newton"}


def test_every_other_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, tables, connection, name):
    assert difference(QUERIES[name](spark, tables), connection, ORACLES[name]) is None


def test_entry_is_ordered(spark, tables):
    rows = entry(spark).collect()
    keys = [(-r["average"], r["word"].encode()) for r in rows]
    assert keys and keys == sorted(keys)

"""Every registered query against its DuckDB oracle SQL (sf0.001)."""

import pytest

from conftest import SF0001
from tools.oracle_check import compare

import __spark_entry__ as E
from evwin.plans import catalog


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, key):
    (k, ok, detail, _), = list(compare(spark, SF0001, [key]))
    assert ok, f"{k}: {detail}"

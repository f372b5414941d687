"""Every registered query against its SQL formulation (DuckDB) at sf0.01:
same columns, types, row count and multiset of values."""

import os

import pytest

import __spark_entry__ as E
from replenix.plans import oracle, queries
from oracle_check import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
KEYS = sorted(queries.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_key_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(KEYS)
    assert set(KEYS) <= set(E.queries()) and set(KEYS) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, key, SF, con)
    assert r["status"] == "ok", r

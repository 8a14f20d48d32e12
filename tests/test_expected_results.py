"""Every registered query against its expected SQL, values and types compared exactly."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from oracle.queries_sql import expected
from tests.compare import assert_same, connect

# The text queries have tests of their own.
EXPECTED = expected()
QUERIES = {key: contract.queries()[key] for key in EXPECTED}


@pytest.fixture(scope="module")
def connection(sf_dir):
    with connect(sf_dir) as connection:
        yield connection


def test_every_query_has_expected_sql():
    text = {"pipeline"} | {key for key in contract.queries() if re.fullmatch(r"op\d+_\w+", key)}
    assert contract.queries().keys() - text == EXPECTED.keys()


@pytest.mark.parametrize("key", QUERIES)
def test_matches_expected(spark, sf_dir, connection, key):
    rows = assert_same(QUERIES[key](spark, sf_dir), connection, EXPECTED[key])
    assert rows > 0


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 3

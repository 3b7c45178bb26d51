"""Every query against its oracle."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from transitloom import registry
from oracle import connect, oracle_rows, spark_rows


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES) <= set(entry.queries())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_oracle(spark, duck, sf_dir, name):
    columns, rows = spark_rows(spark, name, sf_dir)
    want_columns, want_rows = oracle_rows(duck, name)
    assert columns == want_columns
    assert rows == want_rows

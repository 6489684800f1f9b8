"""Registered queries against DuckDB at the smallest scale; ``check_oracles.py`` runs all of them."""

from __future__ import annotations

from pathlib import Path

import pytest
from check_oracles import compare, duck

import __spark_entry__ as entry
from lexmill.plans.table_oracles import ORACLES
from lexmill.plans.table_queries import QUERIES

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(TABLES).exists(), reason="the test tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, name):
    assert compare(spark, duck(TABLES), TABLES, name).startswith("ok")


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_an_oracle_has_rows(spark, name):
    assert QUERIES[name](spark, TABLES).count() > 0


def test_entry_has_rows(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["relative_path", "line_no", "kind", "weight", "text"] and frame.limit(1).count() == 1

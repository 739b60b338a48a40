"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@needs_tables
@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, tables, name):
    problem = compare(spark, tables, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None, problem


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_tables
def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["category", "model", "n"] and df.count() > 0

"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from filmlake.plans.oracle import ORACLE
from filmlake.plans.queries import QUERIES
from tools.compare import connect, differences

FOLDER = os.environ.get("FILMLAKE_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, db, name):
    assert differences(spark, db, FOLDER, name, queries()[name], oracle_sql()[name]) == []


def test_entry(spark):
    assert entry(spark).columns == ["genero", "titulo", "nota_media", "ranking"]

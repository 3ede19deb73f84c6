"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import pytest

from compare import connect, differences
from conftest import DATA
from silverlode.checks import ORACLE, QUERIES

FOLDER = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), ORACLE[name], connection) == []

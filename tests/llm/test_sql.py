"""The numbered queries that SQL expresses give the rows that DuckDB gives."""

import os

import pytest

from spanloom.llm import queries
from tests import oracle

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    said = oracle.compare(spark, oracle.connect(SF_DIR), name, queries.queries()[name], queries.oracle_sql()[name], SF_DIR)
    assert said.startswith("ok"), said

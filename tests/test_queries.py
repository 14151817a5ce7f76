"""Every registered query with SQL gives the rows that DuckDB gives."""

import os

import pytest

from spanloom.plans import catalogue
from tests import oracle

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, name):
    f, sql = catalogue.queries()[name], catalogue.oracle_sql().get(name)
    if sql is None:
        assert f(spark, SF_DIR).count() >= 0
        return
    said = oracle.compare(spark, oracle.connect(SF_DIR), name, f, sql, SF_DIR)
    assert said.startswith("ok"), said


def test_entry_without_the_llm_folder():
    import subprocess
    import sys

    code = "import sys; sys.modules['spanloom.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert len(e.queries()) > 60 and not any(n.startswith('op') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

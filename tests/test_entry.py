import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import tools_compare as C
from tessellar.plans import all_oracles, all_queries

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return C.connect(DATA)


@needs_data
@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_sql(spark, con, name):
    got, want = C.spark_rows(spark, DATA, name), C.sql_rows(con, all_oracles()[name])
    assert got == want and sum(got[1].values()) > 0


@needs_data
def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "field_name" and df.count() > 0


def test_names_agree():
    assert set(all_oracles()) <= set(all_queries()) and {"p1_found", "p2_found", "p3_found"} <= set(all_queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_stands_alone():
    code = "import sys; sys.modules['tessellar.llm'] = None; import __spark_entry__ as e; assert 'p1_found' in e.queries() and not any(k.startswith(('p4', 'p5', 'p6', 'p7', 'p8')) for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.abspath(entry.__file__)))

"""Every registered query: its rows against its SQL, and its plan against what scales."""

import re
from pathlib import Path

import pytest

import __spark_entry__
from fiscalake.checks.compare import connect, differences
from fiscalake.checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

# Results of a bounded size may end in one task: top lists and tables known to be small.
BOUNDED = {
    "top_functions",
    "top_authors",
    "top_states",
    "top_showcases",
    "uf_share",
    "report_authors",
    "report_states",
    "report_showcases",
    "rank_authors",
    "dim_function",
    "dim_place",
    "dim_author",
    "star_denormalised",
    "data_dictionary",
    "fact_joins",
    "fact",
}




@pytest.fixture(scope="module")
def con():
    connection = connect(FOLDER)
    connection.execute("SET TimeZone = 'UTC'")
    return connection


def check_plan(name, df):
    """No cross join, no Python, no window over everything unless the table is small."""
    text = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "InPandas"):
        assert operator not in text
    if name not in BOUNDED:
        for window in re.findall(r"Window \[[^\n]*", text):
            # Of offsets there is one row per partition.
            assert re.search(r"\], \[[^\]]+\], \[", window) or "[_part#" in window, window
    if name == "skewed_join":
        assert re.search(r"SortMergeJoin \[l_suppkey#\w+, _salt#\w+\]", text)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    df = __spark_entry__.queries()[name](spark, FOLDER)
    check_plan(name, df)
    got = df.toArrow()
    assert got.num_rows > 0
    assert differences(con, got, __spark_entry__.oracle_sql()[name]) == []


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns[0] == "autor"

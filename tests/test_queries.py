"""Every registered query against its SQL, on the smallest tables."""

import re
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver
from querybook import all_queries

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
from check import differences  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
WINDOW = re.compile(r"\) Window\nInput.*\nArguments: .*?\], \[([^\]]*)\]")


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, plan, name):
    """Same rows as the SQL, by a plan that multiplies no rows, leaves the JVM for nothing
    and has no window that is one partition."""
    query = all_queries()[name]
    result = query.run(spark, FOLDER)
    text = plan(result)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "PythonUDF"):
        assert bad not in text
    assert text.count(") Window\n") == len(WINDOW.findall(text))
    for keys in WINDOW.findall(text):  # the first list is of partition keys, or of the order if there are none
        assert keys and " ASC" not in keys and " DESC" not in keys
    assert differences(result, FOLDER, query.sql) == ""


def test_driver_functions(spark):
    assert driver.queries().keys() >= all_queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()
    assert driver.entry(spark).count() == 50

"""Every registered query against its SQL, and the shape of its plan."""

import os
import re

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from pricetrail.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    con.execute("SET TimeZone='UTC'")
    return con


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    status, detail = compare(spark, duck, SF, name, QUERIES[name], ORACLES.get(name))
    assert status in ("ok", "rows-only"), (status, detail)


@needs_data
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_plan_has_no_products_or_row_udfs(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not re.search(r"CartesianProduct|BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", plan)
    assert "BroadcastNestedLoopJoin" not in plan


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""Plan checks: no Python UDF, no cartesian product, code lists broadcast."""

import pytest

from tidewater.plans import queries

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_udf_no_cartesian(spark, name):
    text = plan_text(queries.QUERIES[name](spark, SF))
    assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_code_lists_are_broadcast(spark):
    text = plan_text(queries.QUERIES["open_in_transit_lines"](spark, SF))
    assert "BroadcastHashJoin" in text

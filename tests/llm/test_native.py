"""The native operators run no Python per row: nothing in their plans but JVM operators."""

import pytest

from tramline.llm import queries

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "MapInArrow", "PythonMapInArrow",
          "FlatMapGroupsInArrow", "FlatMapGroupsInPandas", "FlatMapCoGroupsInPandas")


@pytest.mark.parametrize("name", ["op1_secret_scan", "op2_license_scan", "op4_chat_format", "op5_pii_pseudonyms", "op6_url_filter"])
def test_native_plans(spark, name):
    plan = queries.REGISTRY[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in PYTHON if x in plan]

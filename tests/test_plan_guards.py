"""Every registered query: no cartesian product, no nested-loop join, no row-wise Python or pandas; Python
at all only in the training-data operators, and of those not in the two that are to be native."""
import pytest

import __spark_entry__ as entry_mod
from microlake.plans import inspect
from microlake.queries import registry

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]
PYTHON = ["MapInArrow", "FlatMapGroupsInArrow", "FlatMapCoGroups"]
NATIVE = ("op8_", "op9_")


@pytest.mark.parametrize("name", sorted(entry_mod.queries()))
def test_plan_has_no_forbidden_operator(spark, name):
    plan = inspect.plan_text(entry_mod.queries()[name](spark, SF), "extended")
    own = name in registry.all_queries() or name.startswith(NATIVE)
    bad = [op for op in FORBIDDEN + PYTHON * own if op in plan]
    assert not bad, (name, bad)

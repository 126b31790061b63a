"""Physical-plan inspection for plan tests: the text ``explain`` prints and
counts of its operators."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

# Operators that mean Python code runs per row or per batch.
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapCoGroupsInPandas", "PythonMapInArrow", "MapInArrow")


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """What ``df.explain(mode)`` prints (the plan before adaptive changes)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_plan(df: DataFrame) -> str:
    text = plan_text(df, "simple")
    return text.split("== Physical Plan ==", 1)[-1]


def count_nodes(df: DataFrame, pattern: str) -> int:
    """Number of plan lines whose operator matches ``pattern`` (a regex)."""
    return sum(1 for line in physical_plan(df).splitlines()
               if re.search(r"^[\s:+\-*()\d]*" + pattern, line))


def exchange_count(df: DataFrame) -> int:
    """Shuffle exchanges (hash, range, round-robin, single partition);
    broadcast exchanges are not counted."""
    return count_nodes(df, r"Exchange ")


def uses_python(df: DataFrame) -> bool:
    plan = physical_plan(df)
    return any(node in plan for node in PYTHON_NODES)


def _nodes(node):
    """A plan node and all below it, through the stages of adaptive execution."""
    yield node
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _nodes(node.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from _nodes(node.plan())
    children = node.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def metric_total(df: DataFrame, operator: str, metric: str) -> int:
    """Sum of a metric over the operators of this class name, after ``df`` has run
    (``collect``, not a write, which plans anew). For tests of what a plan moves."""
    total = 0
    for node in _nodes(df._jdf.queryExecution().executedPlan()):
        found = node.metrics().get(metric)
        if node.getClass().getSimpleName() == operator and found.isDefined():
            total += found.get().value()
    return total

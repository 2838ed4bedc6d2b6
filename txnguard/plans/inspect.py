"""Plan checks: what a reviewer looks for in ``explain("formatted")``.

Used by tests to pin the plans: filters pushed into the Parquet scan, pruned
read schemas, equi-join keys instead of nested loops, no Python UDF nodes.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapCoGroupsInPandas", "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow", "MapInArrow",
                "PythonMapInArrow", "TransformWithState", "ArrowAggregatePython", "ArrowWindowPython",
                "ArrowEvalPythonUDTF", "BatchEvalPythonUDTF", "PythonUDF")
NESTED_LOOP_NODES = ("BroadcastNestedLoopJoin", "CartesianProduct")


def executed_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan(df: DataFrame) -> str:
    """The text ``df.explain("formatted")`` prints."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", formatted_plan(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", formatted_plan(df))


def python_nodes(df: DataFrame) -> list[str]:
    plan = executed_plan(df)
    return [n for n in PYTHON_NODES if n in plan]


def nested_loops(df: DataFrame) -> list[str]:
    plan = executed_plan(df)
    return [n for n in NESTED_LOOP_NODES if n in plan]


def exchange_count(df: DataFrame) -> int:
    """Shuffle exchanges in the initial (pre-AQE) physical plan."""
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
                          executed_plan(df)))

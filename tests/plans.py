"""Reading physical plans in tests."""

from __future__ import annotations

import re


def executed_plan(df) -> str:
    """The physical plan as planned, before adaptive execution changes it."""
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan(df) -> str:
    """The plan with the full details of its scans."""
    utils = df.sparkSession._jvm.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")


def shuffles(df) -> list[str]:
    """The exchanges of a plan without broadcasts, top first."""
    found = re.findall(r"(?<!Broadcast)Exchange (\w+)(\([^)]*\))?", executed_plan(df))
    return [name + arguments for name, arguments in found]


def has_python(df) -> bool:
    return any(word in executed_plan(df) for word in ("EvalPython", "InPandas", "InArrow"))

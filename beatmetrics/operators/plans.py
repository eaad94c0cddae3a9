"""The physical plan as rows, to compare join strategies."""

from __future__ import annotations

import contextlib
import io
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

_NODE = re.compile(r"^[\s:+|-]*(?:\*\(\d+\) )?(?P<node>[A-Z]\w+)(?P<rest>.*)$")
_SIDE = re.compile(r"\bBuild(Left|Right)\b")
PLAN_ROWS = "strategy string, node string, build string, nodes long"


def plan_text(df: DataFrame) -> str:
    """The physical plan as ``explain`` prints it; starts no job."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def plan_nodes(df: DataFrame, only: str = "Join|Exchange") -> Counter:
    """How often each node whose name matches stands in the plan, by (node, build side).

    The side that a hash join builds is ``left`` or ``right``; other nodes have none.
    """
    found: Counter = Counter()
    for line in plan_text(df).splitlines():
        parts = _NODE.match(line)
        if parts and re.search(only, parts["node"]):
            side = _SIDE.search(parts["rest"])
            found[parts["node"], side[1].lower() if side else None] += 1
    return found


def compare_plans(
    spark: SparkSession, frames: dict[str, DataFrame], only: str = "Join|Exchange"
) -> DataFrame:
    """Rows (strategy, node, build, nodes): the plans of one job under several strategies."""
    rows = [
        (strategy, node, side, n)
        for strategy, df in frames.items()
        for (node, side), n in sorted(plan_nodes(df, only).items(), key=str)
    ]
    return spark.createDataFrame(rows, PLAN_ROWS)

"""Choice of the join strategy."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame

# The names of Spark's join hints.
STRATEGIES = ("broadcast", "merge", "shuffle_hash")

BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the frame's size; starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def with_strategy(
    df: DataFrame, strategy: str | None, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """One side of a join with a hint for it.

    Without a strategy Catalyst and AQE decide by size.  A broadcast is only
    asked for when the plan's estimate is at most ``max_bytes``; a larger frame
    goes without the hint, with a warning, so that the join is shuffled.
    """
    if strategy is None:
        return df
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}; choose one of {STRATEGIES}")
    if strategy == "broadcast" and estimated_bytes(df) > max_bytes:
        warnings.warn("no broadcast: the estimated size is beyond the limit", stacklevel=2)
        return df
    return df.hint(strategy)

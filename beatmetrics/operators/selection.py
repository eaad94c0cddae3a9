"""Ranks, top-n selections, membership and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatmetrics.operators.hints import with_strategy


def top_per_group(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    n: int,
    ties: str = "all",
    tie_break: list[Column] | None = None,
    name: str = "position",
) -> DataFrame:
    """The first ``n`` rows of each group, with their position.

    ``ties='all'`` keeps rows that share a position (rank); ``ties='first'``
    numbers them by ``tie_break`` (row_number).  The filter sits directly on
    the window, so that Spark cuts every group down before the shuffle.
    """
    if ties == "all":
        position = F.rank().over(Window.partitionBy(*group).orderBy(*order))
    elif ties == "first":
        position = F.row_number().over(
            Window.partitionBy(*group).orderBy(*order, *(tie_break or []))
        )
    else:
        raise ValueError(f"ties must be 'all' or 'first', not {ties!r}")
    return df.withColumn(name, position).where(F.col(name) <= n)


def top_n(df: DataFrame, by: str, n: int, tie_break: list[str]) -> DataFrame:
    """The ``n`` rows with the highest value; a distributed top-n, no full sort."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tie_break).limit(n)


def bottom_n(
    df: DataFrame, by: str, n: int, tie_break: list[str], nulls: str = "first"
) -> DataFrame:
    """The ``n`` rows with the lowest value; nulls come first or are dropped."""
    if nulls == "drop":
        df = df.where(F.col(by).isNotNull())
    elif nulls != "first":
        raise ValueError(f"nulls must be 'first' or 'drop', not {nulls!r}")
    return df.orderBy(F.col(by).asc_nulls_first(), *tie_break).limit(n)


def keep_members(
    df: DataFrame,
    members: DataFrame,
    on: str,
    distinct: bool = True,
    strategy: str | None = None,
) -> DataFrame:
    """The rows whose key is among the members.

    With ``distinct=False`` a key listed twice counts twice, as in an inner
    join with a UNION ALL.
    """
    members = members.select(on)
    if distinct:
        return df.join(with_strategy(members.distinct(), strategy), on, "left_semi")
    return df.join(with_strategy(members, strategy), on, "inner")

"""Positions of all rows of a large table in one global order.

A window without a partition is one task.  Here the rows are sorted in ranges;
a row's place in its range and the number of rows in the ranges before it, one
number per range, make its position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatmetrics.sources.scratch import scratch_path

# Spark's row numbers hold the partition above so many bits.
PARTITION_BITS = 33


def global_positions(
    df: DataFrame,
    order: list[str],
    descending: tuple[str, ...] = (),
    ties: str = "first",
    name: str = "position",
) -> DataFrame:
    """The rows with their position, as a long, from 1.

    ``ties='first'`` numbers the rows; equal ones get successive numbers in any
    order.  ``ties='all'`` gives equal rows the rank of the first of them.  Rows
    with one key may be any part of the table: they span several ranges.  Nulls
    come first, or last where descending.  The sorted rows are written to the
    shared folder, so that both steps see the same.
    """
    if ties not in ("first", "all"):
        raise ValueError(f"ties must be 'all' or 'first', not {ties!r}")
    spark = df.sparkSession
    if name in df.columns:
        raise ValueError(f"there is a column {name!r} already")
    mark = "_at"
    while any(c.startswith(mark) for c in df.columns):
        mark = "_" + mark
    keys = [F.desc(f"`{c}`") if c in descending else F.asc(f"`{c}`") for c in order]
    spread = F.monotonically_increasing_id()
    sorted_rows = (
        df.withColumn(mark + "_row", spread)
        .repartitionByRange(*keys, mark + "_row")
        .sortWithinPartitions(*keys, mark + "_row")
        .drop(mark + "_row")
        .withColumn(mark, F.monotonically_increasing_id())
    )
    path = scratch_path(spark, "positions")
    sorted_rows.write.parquet(path)
    rows = spark.read.schema(sorted_rows.schema).parquet(path)
    part = F.shiftright(mark, PARTITION_BITS)
    # One number per range.
    counts = sorted(tuple(r) for r in rows.groupBy(part.alias("part")).count().collect())
    before, offsets = 0, []
    for number, n in counts:
        offsets.append((number, before))
        before += n
    starts = spark.createDataFrame(offsets, f"{mark}_part long, {mark}_before long")
    place = F.col(mark).bitwiseAND(F.lit(2**PARTITION_BITS - 1)) + 1
    numbered = (
        rows.join(F.broadcast(starts), part == F.col(mark + "_part"))
        .withColumn(name, F.col(mark + "_before") + place)
        .select(*[f"`{c}`" for c in df.columns], name)
    )
    if ties == "first":
        return numbered
    renamed = {c: f"{mark}_{i}" for i, c in enumerate(order)}
    firsts = numbered.groupBy(*[F.col(f"`{c}`").alias(k) for c, k in renamed.items()]).agg(
        F.min(name).alias(mark)
    )
    same = None
    for c, k in renamed.items():
        equal = F.col(f"`{c}`").eqNullSafe(F.col(k))
        same = equal if same is None else same & equal
    return numbered.join(firsts, same).select(
        *[f"`{c}`" for c in df.columns], F.col(mark).alias(name)
    )

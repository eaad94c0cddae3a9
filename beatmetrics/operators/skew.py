"""Equi-joins whose frequent keys are split.

A shuffle join sends all rows of a key to one task.  Here a sketch of the
frequent keys is taken first: counters of fixed number per task, merged without
a shuffle of rows (Spark's ``approx_top_k``).  Only keys above a share of the
rows are split into several, and only their rows on the other side are
replicated, once per part.  All other keys are joined as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A part of a key has at most this share of the rows.
MAX_SHARE = 0.01
# Counters of the sketch per task; counts are exact while there are fewer keys.
COUNTERS = 10_000


def _key(on: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in on])


def frequent_keys(df: DataFrame, on: list[str], share: float = MAX_SHARE) -> dict[int, int]:
    """Hashes of the keys above a share of the rows, and the parts to split them into.

    At most 1 / ``share`` keys can be that frequent, so that is what the driver sees.
    """
    most = math.ceil(1 / share)
    found = (
        df.select(_key(on).alias("key"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.expr(f"approx_top_k(key, {most}, {max(COUNTERS, 4 * most)})").alias("top"),
        )
        .first()
    )
    limit = found.rows * share
    return {t.item: math.ceil(t["count"] / limit) for t in found.top or [] if t["count"] > limit}


def split_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    share: float = MAX_SHARE,
) -> DataFrame:
    """``left.join(right, on, how)`` with the frequent keys of ``left`` split.

    ``how`` is ``inner`` or ``left``.  The left side is read twice, once for the
    sketch.  Rows of a null key match nothing; in a left join they are split
    like those of any key.  Repeated rows stay as often as they are.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    if how == "inner":
        left = left.dropna(subset=on)
    parts = frequent_keys(left, on, share)
    if not parts:
        return left.join(right, on, how)
    number = F.coalesce(
        F.create_map(*[F.lit(x) for item in parts.items() for x in item])[_key(on)], F.lit(1)
    )
    part = "_part"
    while part in (*left.columns, *right.columns):
        part = "_" + part
    # Row numbers, not hashes: a frequent key may have equal rows.
    row = F.monotonically_increasing_id()
    split = left.withColumn(part, F.when(number > 1, F.pmod(row, number)).otherwise(0).cast("int"))
    copies = right.withColumn(part, F.explode(F.sequence(F.lit(0), number - 1)))
    return split.join(copies, [*on, part], how).drop(part)

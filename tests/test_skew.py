"""The join with split frequent keys: rows, and how they are dealt to tasks."""

import pytest
from pyspark.sql import functions as F

from beatmetrics.operators.skew import frequent_keys, split_join
from beatmetrics.plans import reports


def pairs(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def sides(spark):
    """A hot key of equal rows, a frequent null, a text with quotes, and rare keys."""
    rows = [("hot", 1)] * 400 + [(None, 2)] * 200 + [("o'`x", 3)] * 50
    rows += [(f"k{i % 150}", i) for i in range(350)]
    left = spark.createDataFrame(rows, "`a key` string, _part int").repartition(6)
    other = [("hot", "a"), ("hot", "b"), (None, "c"), ("o'`x", "d"), ("k1", "e"), ("none", "f")]
    return left, spark.createDataFrame(other, "`a key` string, v string")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_as_a_plain_join(sides, how):
    left, right = sides
    found = split_join(left, right, ["a key"], how)
    assert found.columns == ["a key", "_part", "v"]
    assert pairs(found) == pairs(left.join(right, ["a key"], how))
    empty = left.limit(0)
    assert split_join(empty, right, ["a key"], how).count() == 0
    assert pairs(split_join(left, right.limit(0), ["a key"], how)) == pairs(
        left.join(right.limit(0), ["a key"], how)
    )


def test_only_frequent_keys_are_split(sides):
    left, _ = sides
    assert sorted(frequent_keys(left, ["a key"], 0.05).values()) == [4, 8]
    assert frequent_keys(left.where("`a key` LIKE 'k%'"), ["a key"], 0.05) == {}
    with pytest.raises(ValueError):
        split_join(left, left, ["a key"], "full")


def test_no_task_has_a_twentieth_of_the_rows(spark):
    """A third of all rows under one of 25 areas, without adaptive execution."""
    area = F.when(F.col("id") % 3 == 0, 7).otherwise(1 + F.col("id") % 25)
    incidents = spark.range(60_000).select(F.lpad(area.cast("string"), 2, "0").alias("area_code"))
    stations = spark.range(1, 26).selectExpr(
        "cast(id AS int) AS prec", "cast(id AS string) AS division", "34e0 AS lat", "-118e0 AS lon"
    )
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "211",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for strategy, low, high in (("merge", 0.33, 1.0), ("split", 0.0, 0.05)):
            joined = reports.assigned_station(incidents, stations, strategy)
            tasks = joined.groupBy(F.spark_partition_id()).count().collect()
            assert sum(r["count"] for r in tasks) == 60_000
            assert low <= max(r["count"] for r in tasks) / 60_000 <= high
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

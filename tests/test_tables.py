"""Exact means, global positions, observed writes and plans as rows."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from beatmetrics.functions.sums import LARGEST, exact_mean, exact_sum
from beatmetrics.operators.plans import compare_plans, plan_nodes
from beatmetrics.operators.positions import global_positions
from beatmetrics.plans import reports
from beatmetrics.sources import writers
from beatmetrics.sources.derived import load


def test_exact_sums_in_any_order(spark):
    chance = random.Random(5)
    values = [chance.choice([1, -1]) * chance.random() * 10 ** chance.randint(-9, 4) for _ in range(4000)]
    values += [None, math.nan, float(LARGEST), -float(LARGEST), 0.0, -0.0, 2.0**-40, 0.1]
    rows = [(v, chance.randint(1, 10**6)) for v in values]
    good = [(v, n) for v, n in rows if v is not None and abs(v) < LARGEST]
    units = sum(round(v * 2**40) * n for v, n in good)
    mean = Fraction(units, 2**40 * sum(n for _, n in good))
    found = set()
    for parts in (1, 7, 211):
        chance.shuffle(rows)
        df = spark.createDataFrame(rows, "v double, n long").repartition(parts)
        found.add(tuple(df.agg(exact_sum(F.col("v"), F.col("n")), exact_mean(F.col("v"), F.col("n"))).first()))
    assert len(found) == 1
    ((total, got),) = found
    assert int(total) == units and got == pytest.approx(float(mean), rel=1e-14)
    none = spark.createDataFrame([(None,)], "v double").agg(exact_mean(F.col("v"))).first()
    assert none[0] is None


def test_reports_are_equal_to_the_last_bit_for_any_partitioning(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(reports.F, "round", lambda c, digits: c)
    incidents, stations = load(spark, sf_dir, "incidents"), load(spark, sf_dir, "stations")
    found = set()
    for parts in (1, 7, 211):
        rows = incidents.repartition(parts, F.rand(parts))
        report = reports.assigned_station_by_year(rows, stations).collect()
        found.add(tuple(map(tuple, report)))
    assert len(found) == 1 and len(next(iter(found))) > 3


@pytest.fixture(scope="module")
def tied(spark):
    """Half of the rows under one key, so that ties span many ranges."""
    chance = random.Random(2)
    rows = [(None if i % 97 == 0 else "hot" if i % 2 else f"k{chance.randint(0, 300):03}", i) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "`a key` string, _at int").repartition(9)


@pytest.mark.parametrize("down", [False, True])
def test_positions_equal_those_of_one_task(spark, tied, down):
    rows, df = tied
    descending = ("a key",) if down else ()

    def place(key):
        return (key is not None, key or "") if not down else (key is None, [-ord(c) for c in key or ""])

    keys = sorted(place(k) for k, _ in rows)
    first = {str(k): i for i, k in reversed(list(enumerate(keys, 1)))}
    ranked = global_positions(df, ["a key"], descending, "all")
    assert ranked.columns == ["a key", "_at", "position"]
    assert sorted((r["_at"], r.position) for r in ranked.collect()) == sorted(
        (i, first[str(place(k))]) for k, i in rows
    )
    numbered = global_positions(df, ["a key"], descending).collect()
    assert sorted(r.position for r in numbered) == list(range(1, 3001))
    by_place = sorted(numbered, key=lambda r: r.position)
    assert [str(place(r["a key"])) for r in by_place] == [str(k) for k in keys]


def test_positions_of_nothing_and_wrong_options(spark, tied):
    _, df = tied
    assert global_positions(df.limit(0), ["a key"]).collect() == []
    assert global_positions(df.limit(0), ["a key"], ties="all").collect() == []
    for options in ({"ties": "some"}, {"name": "_at"}):
        with pytest.raises(ValueError):
            global_positions(df, ["a key"], **options)


def test_positions_have_no_task_of_all_rows(tied):
    plan = global_positions(tied[1], ["a key"], ties="all")._jdf.queryExecution().executedPlan()
    assert "SinglePartition" not in plan.toString() and "Window" not in plan.toString()


def test_counts_come_with_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (3, None), (None, "a,\"b")], "`a b` int, rows string")
    found = writers.write_csv_observed(
        df, f"{tmp_path}/out", {"even": F.col("`a b`") % 2 == 0, "y": F.col("rows") == "y"}
    )
    assert found == [("a b", 4, 2), ("rows", 4, 1), ("even", 4, 0), ("y", 4, 1)]
    back = spark.read.csv(f"{tmp_path}/out", header=True, escape='"')
    assert back.count() == 4 and back.columns == ["a b", "rows"]
    assert writers.write_csv_observed(df.limit(0), f"{tmp_path}/none") == [("a b", 0, 0), ("rows", 0, 0)]


def test_plans_as_rows(spark):
    a, b = spark.range(10), spark.range(5)
    frames = {s: a.join(b.hint(s), "id") for s in ("broadcast", "merge", "shuffle_hash")}
    rows = compare_plans(spark, frames).collect()
    assert {(r.strategy, r.node, r.build) for r in rows if "Join" in r.node} == {
        ("broadcast", "BroadcastHashJoin", "right"),
        ("merge", "SortMergeJoin", None),
        ("shuffle_hash", "ShuffledHashJoin", "right"),
    }
    exchanges = {r.strategy: r.nodes for r in rows if r.node == "Exchange"}
    assert exchanges == {"merge": 2, "shuffle_hash": 2}
    assert plan_nodes(frames["broadcast"], "Exchange") == {("BroadcastExchange", None): 1}

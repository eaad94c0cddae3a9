"""The geodesic distance in columns against the solver on arrays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from beatmetrics.functions.distance import vincenty_km, with_distance_km
from beatmetrics.functions.geodesic import with_geodesic_km

RNG = np.random.default_rng(21)


def places(n, low, high):
    return RNG.uniform([low[0], low[1]] * 2, [high[0], high[1]] * 2, (n, 4))


def opposite(n):
    lat, lon = RNG.uniform(-80, 80, n), RNG.uniform(-170, 0, n)
    near = RNG.uniform(-0.4, 0.4, (2, n))
    return np.stack([lat, lon, near[0] - lat, lon + 180 + near[1]], axis=1)


ODD = np.array(
    [
        [0, 0, 0, 180], [0, 0, 0, 179.5], [90, 0, -90, 7], [90, 5, 90, 100], [0, 0, 0, 0],
        [12, 34, 12, 34], [0, 179.9, 0, -179.9], [-90, 0, 10, 10], [0, 10, 0, 11],
        [45, 10, -45, -170], [34, -118, 34, 242], [1e-9, 0, -1e-9, 0], [30, 10, -30, 189.9],
    ]
)
SETS = {
    "world": places(500, (-90, -180), (90, 180)),
    "city": places(500, (33.7, -118.7), (34.4, -118.1)),
    "opposite": opposite(300),
    "odd": ODD,
}


@pytest.mark.parametrize("name", SETS)
def test_within_a_millimetre_of_the_solver(spark, name):
    rows = SETS[name]
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double, c double, d double")
    got = with_distance_km(df, "a", "b", "c", "d", name="km").collect()
    assert [tuple(r)[:4] for r in got] == [tuple(r) for r in rows.tolist()]
    assert [r.km for r in got] == pytest.approx(vincenty_km(*rows.T).tolist(), abs=1e-6)


def test_null_without_a_place_and_clashing_names(spark):
    rows = [(None, 1.0, 2.0, 3.0), (95.0, 1.0, 2.0, 3.0), (1.0, float("nan"), 2.0, 3.0), (1.0, 1.0, 2.0, None)]
    df = spark.createDataFrame(rows, "`_g_lam` double, `_G x` double, km double, d double")
    found = with_geodesic_km(
        df, F.col("_g_lam"), F.col("`_G x`"), F.col("km"), F.col("d"), "km"
    )
    assert found.columns == ["_g_lam", "_G x", "d", "km"]
    assert [r.km for r in found.collect()] == [None] * 4
    whole = df.selectExpr("cast(1 AS int) AS a", "2L AS b", "cast('3' AS string) AS c", "4.5 AS d")
    km = with_distance_km(whole, "a", "b", "c", "d").first().distance_km
    assert km == pytest.approx(float(vincenty_km(1, 2, 3, 4.5)), abs=1e-6)


def test_no_row_leaves_the_jvm_and_the_code_is_compiled(spark):
    df = spark.range(10).selectExpr("id * 1e0 AS a", "2e0 AS b", "3e0 AS c", "id * 4e0 AS d")
    found = with_distance_km(df, "a", "b", "c", "d")
    plan = found._jdf.queryExecution().executedPlan()
    assert "Python" not in plan.toString()
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    stages = getattr(debug, "MODULE$").codegenStringSeq(plan)
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    # Beyond 8,000 bytes a method is interpreted.
    assert sizes and max(sizes) < 8000

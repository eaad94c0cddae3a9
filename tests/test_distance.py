import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from beatmetrics.functions.distance import (
    HAVERSINE_ERROR,
    register_functions,
    vincenty_km,
    with_distance_km,
)

latitudes = st.floats(-89.0, 89.0)
longitudes = st.floats(-180.0, 180.0)


def dms(degrees, minutes, seconds):
    return math.copysign(abs(degrees) + minutes / 60 + seconds / 3600, degrees)


def test_published_line():
    """The line from Flinders Peak to Buninyong of the Australian geodetic manual."""
    km = vincenty_km(
        dms(-37, 57, 3.72030), dms(144, 25, 29.52440), dms(-37, 39, 10.15610), dms(143, 55, 35.38390)
    )
    assert float(km) == pytest.approx(54.972271, abs=1e-6)


@pytest.mark.parametrize(
    "line, km",
    [
        ((0, 0, 0, 1), 6378.137 * math.pi / 180),
        ((0, 179.5, 0, -179.5), 6378.137 * math.pi / 180),
        ((0, 0, 90, 0), 10001.965729),
        ((90, 12, -90, 12), 2 * 10001.965729),
        ((34.05, -118.25, 34.05, -118.25), 0.0),
    ],
)
def test_equator_meridian_and_equal_points(line, km):
    assert float(vincenty_km(*line)) == pytest.approx(km, abs=1e-6)


def test_missing_and_impossible_input():
    lines = np.array([[np.nan, 0, 0, 0], [91, 0, 0, 0], [0, 0, np.nan, 1], [1, 1, 1, 2]])
    got = vincenty_km(*lines.T)
    assert np.isnan(got).tolist() == [True, True, True, False]


@pytest.mark.parametrize(
    "line, km",
    [
        ((0, 0, 0.5, 179.5), 19936.288579),
        ((0, 0, 0.5, 179.7), 19944.127421),
        ((0, 0, 0, 180), 2 * 10001.965729),
        ((30, 20, -30, -160), 2 * 10001.965729),
        ((0.5, 179.7, 0, 0), 19944.127421),
        ((0, 0, -0.5, -179.7), 19944.127421),
    ],
)
def test_nearly_opposite_points(line, km):
    assert float(vincenty_km(*line)) == pytest.approx(km, abs=1e-5)


def test_bisection_agrees_with_the_iteration():
    """Without any step of the iteration every pair is left to the bisection."""
    rng = np.random.default_rng(3)
    lines = np.stack([rng.uniform(-89, 89, 400), rng.uniform(-180, 180, 400)] * 2)
    lines[2] = rng.uniform(-89, 89, 400)
    lines[3] = rng.uniform(-180, 180, 400)
    np.testing.assert_allclose(vincenty_km(*lines, steps=0), vincenty_km(*lines), atol=1e-6)


@given(latitudes, longitudes, latitudes, longitudes)
@settings(max_examples=300, deadline=None)
def test_symmetric_not_negative_and_near_haversine(lat1, lon1, lat2, lon2):
    there = float(vincenty_km(lat1, lon1, lat2, lon2))
    back = float(vincenty_km(lat2, lon2, lat1, lon1))
    assert there >= 0
    assert there == pytest.approx(back, abs=1e-6)
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2
    a += math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(
        math.radians(lon2 - lon1) / 2
    ) ** 2
    haversine = 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, a)))
    assert abs(there - haversine) <= HAVERSINE_ERROR * max(there, haversine) + 1e-6


def test_distance_does_not_depend_on_the_batch():
    rng = np.random.default_rng(7)
    lines = np.stack(
        [rng.uniform(-89, 89, 500), rng.uniform(-180, 180, 500)] * 2
    ) + rng.normal(0, 0.2, (4, 500)) / 10
    whole = vincenty_km(*lines)
    single = np.array([float(vincenty_km(*lines[:, i])) for i in range(lines.shape[1])])
    np.testing.assert_array_equal(whole, single)


def test_columns_of_both_models(spark):
    rows = [(34.0, -118.2, 34.1, -118.3), (34.0, -118.2, 34.0, -118.2), (None, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").coalesce(1)
    exact = [r.km for r in with_distance_km(df, "a", "b", "c", "d", name="km").collect()]
    sphere = [
        r.km for r in with_distance_km(df, "a", "b", "c", "d", "haversine", "km").collect()
    ]
    assert exact[0] == pytest.approx(float(vincenty_km(*rows[0])), abs=1e-12)
    assert sphere[0] == pytest.approx(exact[0], rel=HAVERSINE_ERROR)
    assert exact[1] == sphere[1] == 0.0
    assert exact[2] is None and sphere[2] is None
    with pytest.raises(ValueError):
        with_distance_km(df, "a", "b", "c", "d", "flat")


def test_registered_function(spark):
    register_functions(spark)
    row = spark.sql("SELECT geodesic_km(34.0D, -118.2D, 34.1D, -118.3D) AS km").first()
    assert row.km == pytest.approx(float(vincenty_km(34.0, -118.2, 34.1, -118.3)), abs=1e-12)

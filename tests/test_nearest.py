"""The nearest-site search against brute force over all pairs, on small frames."""

import numpy as np
import pytest

from beatmetrics.functions.distance import vincenty_km
from beatmetrics.operators.nearest import keep_nearest, nearest_sites, nearest_sites_per_row

RNG = np.random.default_rng(11)


def haversine(lat1, lon1, lat2, lon2):
    a = np.sin(np.radians(lat2 - lat1) / 2) ** 2
    a = a + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * np.sin(
        np.radians(lon2 - lon1) / 2
    ) ** 2
    return 2 * 6371.0088 * np.arcsin(np.sqrt(np.minimum(1, a)))


def brute_force(points, sites, model):
    distance = vincenty_km if model == "geodesic" else haversine
    p, s = np.array(points, dtype=float), np.array(sites, dtype=float)
    km = distance(p[:, None, 0], p[:, None, 1], s[None, :, 0], s[None, :, 1])
    return np.nanmin(km, axis=1)


def city(n, spread=0.4):
    return [(34.0 + v, -118.3 + w) for v, w in RNG.uniform(-spread, spread, (n, 2)).tolist()]


def world(n):
    return [(float(v), float(w)) for v, w in zip(RNG.uniform(-90, 90, n), RNG.uniform(-180, 180, n))]


EDGES = [(0.0, 180.0), (0.0, -180.0), (10.0, 179.99), (90.0, 0.0), (-90.0, 55.0), (0.0, 0.0)]

LAYOUTS = {
    "city": (city(300), city(25)),
    "dense sites": (city(200), city(400, 0.05)),
    "far points": (world(120), city(60, 0.1)),
    "world": (world(300) + EDGES, world(80)),
    "edges": (EDGES + world(50), EDGES[:4] + [(-89.9, 10.0)]),
    "one site": (world(80), [(12.0, 77.0)]),
    "one point": ([(34.0, -118.0)], world(50)),
}


@pytest.mark.parametrize("model", ["geodesic", "haversine"])
@pytest.mark.parametrize("layout", LAYOUTS)
def test_same_as_brute_force(spark, layout, model):
    points, sites = LAYOUTS[layout]
    df = spark.createDataFrame(
        [(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "id int, lat double, lon double"
    )
    places = spark.createDataFrame(
        [(i, float(a), float(b)) for i, (a, b) in enumerate(sites)],
        "site int, site_lat double, site_lon double",
    )
    found = {}
    for row in nearest_sites(df, places, model).collect():
        found.setdefault(row.id, []).append((row.site, row.distance_km))
    expected = brute_force(points, sites, model)
    assert sorted(found) == list(range(len(points)))
    for i, km in enumerate(expected):
        if np.isnan(km):
            continue
        for site, distance in found[i]:
            assert distance == pytest.approx(km, abs=1e-6)


@pytest.mark.parametrize("finest_level", [1, 4, 9, 18, 24])
def test_cube_size_does_not_matter(spark, finest_level):
    points, sites = city(60) + world(20), city(30) + world(5)
    df = spark.createDataFrame(points, "lat double, lon double")
    places = spark.createDataFrame(sites, "site_lat double, site_lon double")
    rows = nearest_sites(df, places, finest_level=finest_level).collect()
    got = {(r.lat, r.lon): r.distance_km for r in rows}
    expected = brute_force(points, sites, "geodesic")
    for point, km in zip(points, expected):
        assert got[point] == pytest.approx(km, abs=1e-9)


def tie_frames(spark):
    points = spark.createDataFrame(
        [(1, 34.0, -118.0), (2, 34.0, -118.0), (3, 34.5, -118.0)], "id int, lat double, lon double"
    )
    sites = spark.createDataFrame(
        [("a", 34.1, -118.0), ("b", 34.1, -118.0), ("c", 34.9, -118.0)],
        "name string, site_lat double, site_lon double",
    )
    return points, sites


def test_ties_all_and_first(spark):
    points, sites = tie_frames(spark)
    for search in (nearest_sites, nearest_sites_per_row):
        every = sorted((r.id, r.name) for r in search(points, sites).collect())
        assert every == [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (3, "b")] or every == [
            (1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "c")
        ]
        first = sorted((r.id, r.name) for r in search(points, sites, ties="first").collect())
        assert [i for i, _ in first] == [1, 2, 3]
        assert first[:2] == [(1, "a"), (2, "a")]


def test_rows_without_a_location_are_left_out(spark):
    points = spark.createDataFrame(
        [(1, 34.0, -118.0), (2, None, -118.0), (3, 34.0, None), (4, 95.0, 0.0)],
        "id int, lat double, lon double",
    )
    sites = spark.createDataFrame(
        [(34.1, -118.0), (None, 1.0)], "site_lat double, site_lon double"
    )
    assert [r.id for r in nearest_sites(points, sites).collect()] == [1]


def test_no_sites_and_no_points(spark):
    points, sites = tie_frames(spark)
    assert nearest_sites(points, sites.limit(0)).count() == 0
    assert nearest_sites(points.limit(0), sites).count() == 0


def test_repeated_ids_compete(spark):
    """As a rank per id: of two rows with one id only the nearer one stays."""
    points = spark.createDataFrame(
        [("x", 34.0, -118.0), ("x", 35.0, -118.0), ("y", 35.0, -118.0), (None, 35.0, -118.0)],
        "id string, lat double, lon double",
    )
    sites = spark.createDataFrame([("s", 34.1, -118.0)], "name string, site_lat double, site_lon double")
    rows = nearest_sites_per_row(points, sites, key=["id"]).collect()
    assert sorted((r.id or "", r.lat) for r in rows) == [("", 35.0), ("x", 34.0), ("y", 35.0)]


def test_a_third_of_all_rows_at_one_place_and_id(spark):
    hot = [("hot", 34.0, -118.0)] * 2000
    rest = [(f"r{i}", a, b) for i, (a, b) in enumerate(city(4000))]
    points = spark.createDataFrame(hot + rest, "id string, lat double, lon double")
    places = city(25)
    sites = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(places)], "site int, site_lat double, site_lon double"
    )
    found = nearest_sites_per_row(points, sites, key=["id"])
    assert found.count() == 6000
    assert found.where("id = 'hot'").count() == 2000


def test_keep_nearest_first_keeps_one_row_per_key(spark):
    pairs = spark.createDataFrame(
        [("x", "b", 1.0), ("x", "a", 1.0), ("x", "c", None), ("y", "c", None)],
        "id string, site string, distance_km double",
    )
    rows = sorted((r.id, r.site) for r in keep_nearest(pairs, ["id"], "first").collect())
    assert rows == [("x", "a"), ("y", "c")]
    every = sorted((r.id, r.site) for r in keep_nearest(pairs, ["id"]).collect())
    assert every == [("x", "a"), ("x", "b"), ("y", "c")]


def test_many_sites_are_not_broadcast(spark):
    """Each site stands once per level, which the planner does not count."""
    points, n = city(20), 20_000
    df = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(points)], "id int, lat double, lon double"
    )
    places = spark.range(n).selectExpr(
        "id AS site",
        "33.5e0 + 0.0001e0 * ((id * 7919) % 10007) AS site_lat",
        "-118.8e0 + 0.0001e0 * ((id * 104729) % 10009) AS site_lon",
    )
    found = nearest_sites(df, places)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().sparkPlan().toString()
    rows = found.collect()
    sites = [(r.site_lat, r.site_lon) for r in places.collect()]
    expected = brute_force(points, sites, "geodesic")
    assert {r.id for r in rows} == set(range(len(points)))
    for r in rows:
        assert r.distance_km == pytest.approx(expected[r.id], abs=1e-6)

"""Branch and bound and k nearest sites against brute force, and the pairs that each round leaves."""

import numpy as np
import pytest

from beatmetrics.functions.distance import vincenty_km
from beatmetrics.operators import descent, nearest
from beatmetrics.operators.nearest import nearest_sites
from tests.test_nearest import LAYOUTS, city, haversine, world

DISTANCE = {"geodesic": vincenty_km, "haversine": haversine}


def frames(spark, points, sites):
    return (
        spark.createDataFrame(
            [(i, float(a), float(b)) for i, (a, b) in enumerate(points)],
            "id int, lat double, lon double",
        ),
        spark.createDataFrame(
            [(i, float(a), float(b)) for i, (a, b) in enumerate(sites)],
            "site int, site_lat double, site_lon double",
        ),
    )


def kth(points, sites, model, k):
    p, s = np.array(points, dtype=float), np.array(sites, dtype=float)
    km = DISTANCE[model](p[:, None, 0], p[:, None, 1], s[None, :, 0], s[None, :, 1])
    return np.sort(np.where(np.isnan(km), np.inf, km), axis=1)[:, : min(k, len(sites))]


def check(rows, points, sites, model, k):
    """Distances of the k nearest sites; with ties any further site is as near as the k-th."""
    found = {}
    for row in rows:
        found.setdefault(row.id, []).append(row.distance_km)
    expected = kth(points, sites, model, k)
    assert sorted(found) == list(range(len(points)))
    for i, km in enumerate(expected):
        own = sorted(found[i])
        assert own[: len(km)] == pytest.approx(km.tolist(), abs=1e-6)
        assert all(x == pytest.approx(km[-1], abs=1e-6) for x in own[len(km) :])


@pytest.mark.parametrize("layout", LAYOUTS)
def test_three_nearest_equal_brute_force(spark, layout):
    points, sites = LAYOUTS[layout]
    sites = sites + sites[: len(sites) // 2]  # ties
    check(nearest_sites(*frames(spark, points, sites), k=3).collect(), points, sites, "geodesic", 3)


@pytest.mark.parametrize("model,k", [("geodesic", 1), ("haversine", 1), ("geodesic", 3)])
@pytest.mark.parametrize("layout", ["dense sites", "far points", "world", "edges", "mixed"])
def test_branch_and_bound_equals_brute_force(spark, monkeypatch, layout, model, k):
    """With a limit that makes most points crowded."""
    monkeypatch.setattr(nearest, "CROWD", 3)
    monkeypatch.setattr(descent, "FEW", 2)
    layouts = LAYOUTS | {"mixed": (world(40) + city(60), city(80, 0.02) + world(10))}
    points, sites = layouts[layout]
    sites = sites + sites[:3]
    monkeypatch.setattr(descent, "MANY", 10)
    found = nearest_sites(*frames(spark, points, sites), model, k=k)
    check(found.collect(), points, sites, model, k)


def test_k_nearest_numbers_and_ranks(spark):
    points, sites = frames(spark, [(34.0, -118.0)] * 2, [(34.1, -118.0)] * 2 + [(34.2, -118.0)] * 2)
    rows = nearest_sites(points, sites, k=3).collect()
    assert sorted((r.id, r.site, r.position) for r in rows) == [
        (i, s, 1 if s < 2 else 3) for i in (0, 1) for s in range(4)
    ]
    rows = nearest_sites(points, sites, k=3, ties="first").collect()
    assert sorted((r.id, r.site, r.position) for r in rows) == [
        (i, s, s + 1) for i in (0, 1) for s in range(3)
    ]
    assert nearest_sites(points, sites, k=9).count() == 8
    assert nearest_sites(points, sites.limit(0), k=2).count() == 0
    with pytest.raises(ValueError):
        nearest_sites(points, sites, k=0)


def test_far_points_and_crowded_sites_leave_few_pairs(spark, monkeypatch):
    """20,000 far points and 5,000 sites of a few streets: no round has 5 % of all pairs."""
    random = np.random.default_rng(4)
    points = [(float(a), float(b)) for a, b in random.uniform((-40, 115), (-20, 150), (20_000, 2))]
    sites = [(float(a), float(b)) for a, b in random.uniform((34, -118.1), (34.1, -118), (5_000, 2))]
    df, places = frames(spark, points, sites)
    sizes = []
    refine, compared = descent.refine, descent.compared

    def counted_refine(*args):
        pairs = descent.written(refine(*args), "counted")
        sizes.append(pairs.count())
        return pairs

    def counted_compared(*args):
        pairs = descent.written(compared(*args), "counted")
        sizes.append(pairs.count())
        return pairs

    monkeypatch.setattr(descent, "refine", counted_refine)
    monkeypatch.setattr(descent, "compared", counted_compared)
    rows = nearest_sites(df, places).collect()
    print(sizes)
    assert max(sizes) < 0.05 * len(points) * len(sites)
    some = random.choice(len(points), 200, replace=False)
    got = {r.id: r.distance_km for r in rows}
    assert len(got) == len(points)
    expected = kth([points[i] for i in some], sites, "geodesic", 1)[:, 0]
    assert [got[i] for i in some] == pytest.approx(expected.tolist(), abs=1e-6)

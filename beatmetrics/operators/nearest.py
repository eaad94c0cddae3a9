"""Nearest-site search as equi-joins on grid cells.

The Earth is taken as the unit sphere and cut into cubes: at level k a cube
has the edge 2 / 2**k, and the eight cubes of level k + 1 that fill it carry
its index times two.  Cubes know no date line and no poles.

Comparing every point with every site would grow with the product of both
tables.  Instead

1. the occupied cubes of the points at the finest level are collected;
2. each of them looks up the finest level at which the cube around it holds a
   site.  That site is at most sqrt(3) edges away, so the nearest one lies in
   the 27 cubes around it on the level above, whose edge is twice as long;
3. an equi-join on (level, cube) fetches the sites of those 27 cubes, and the
   ones that cannot be nearest to any place in the point's cube are left out;
4. the points join what is left for their own cube, and only here the real
   distance is computed and ranked.

All steps are joins and aggregations on keys, exact for every point, and none
of them needs either table to be small.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatmetrics.functions.distance import HAVERSINE_ERROR, distance_km
from beatmetrics.operators import descent
from beatmetrics.operators.selection import top_per_group
from beatmetrics.operators.skew import split_join

# Sites around a cube of the points beyond which they are not compared one by one.
CROWD = 4 * descent.FEW
# Rows of the sites' cubes that may be broadcast.  Spark takes them for as many as there are
# sites, though each stands there once per level, so more of them are joined by sorting.
MOST_PLACED = 100_000

# A point's own finest cube, and the cube around it on the column "level".
_OWN = ["_own_x", "_own_y", "_own_z"]
_CUBE = ["_level", "_x", "_y", "_z"]


def _xyz(lat: str, lon: str) -> tuple[str, str, str]:
    return (
        f"cos(radians({lat})) * cos(radians({lon}))",
        f"cos(radians({lat})) * sin(radians({lon}))",
        f"sin(radians({lat}))",
    )


def own_cube(lat: str, lon: str, level: int) -> list[str]:
    # The last cube of an axis is closed, so that level 0 is one cube for all.
    return [
        f"least(cast(floor(({v} + 1e0) * {2 ** level}e0 / 2e0) AS int), {2 ** level - 1}) AS {own}"
        for v, own in zip(_xyz(lat, lon), _OWN)
    ]


def levels(finest: int) -> str:
    return f"explode(sequence(0, {finest})) AS _level"


def around_own(finest: int) -> list[str]:
    """The cube of the column ``_level`` that holds the own cube."""
    return [
        f"shiftright({own}, {finest} - _level) AS {name}" for own, name in zip(_OWN, _CUBE[1:])
    ]


def neighbours(finest: int) -> list[str]:
    """The cube on the column ``_level`` next to that around the own one, by ``_n`` in 0 to 26."""
    steps = ("_n % 3", "_n div 3 % 3", "_n div 9")
    return [
        f"cast(shiftright({own}, {finest} - _level) + {step} - 1 AS int) AS {name}"
        for own, step, name in zip(_OWN, steps, _CUBE[1:])
    ]


def chord(lat: str, lon: str, finest: int) -> str:
    """From the centre of the own cube to a place."""
    edge = 2.0 ** (1 - finest)
    squares = [
        f"power(({own} + 5e-1) * {edge:.17e} - 1e0 - {v}, 2)" for own, v in zip(_OWN, _xyz(lat, lon))
    ]
    return f"sqrt({' + '.join(squares)})"


def slack(model: str) -> float:
    """How much longer a chord may be and still stand for the shorter distance."""
    error = HAVERSINE_ERROR if model == "geodesic" else 0.0
    # The last factor covers rounding in the cube arithmetic.
    return (1 + error) / (1 - error) * (1 + 1e-9)


def can_win(finest: int, slack: float) -> str:
    """Whether a site at ``_chord`` can be nearer to a place of the cube than one at ``_best``."""
    # Every place of the cube is within half a diagonal of its centre.
    radius = math.sqrt(3) / 2 * 2.0 ** (1 - finest)
    return f"_chord <= (_best + {radius:.17e}) * {slack!r}D + {radius:.17e}"


def finest_level_for(site_count: int) -> int:
    """Cubes of 800 m for up to some ten thousand sites, finer ones for more.

    A cube should be small against the space between sites, so that few of them
    compete in it, but there should not be many more cubes than points.
    """
    return min(24, max(14, 8 + int(math.log2(max(site_count, 1)) / 2)))


def _places(sites: DataFrame, finest: int) -> DataFrame:
    """Rows (_site, _level, cube): every site in its cubes of all levels."""
    return (
        sites.select(F.struct(*sites.columns).alias("_site"))
        .selectExpr("_site", *own_cube("_site.site_lat", "_site.site_lon", finest), levels(finest))
        .selectExpr("_site", "_level", *around_own(finest))
    )


def _around(
    cubes: DataFrame, places: DataFrame, finest: int, k: int, join=DataFrame.join
) -> DataFrame:
    """For each occupied cube of the points the 27 cubes that hold its k nearest sites."""
    holding = (
        places.select(*_CUBE).distinct()
        if k == 1
        else places.groupBy(*_CUBE).agg(F.count("*").alias("_n")).where(F.col("_n") >= k)
    )
    outer = cubes.selectExpr(*_OWN, levels(finest)).selectExpr(*_OWN, "_level", *around_own(finest))
    reach = (
        join(outer, holding.select(*_CUBE), _CUBE)
        .groupBy(*_OWN)
        .agg(F.expr("greatest(max(_level) - 1, 0) AS _level"))
    )
    return reach.selectExpr(*_OWN, "_level", "explode(sequence(0, 26)) AS _n").selectExpr(
        *_OWN, "_level", *neighbours(finest)
    )


def _candidates(
    around: DataFrame, places: DataFrame, finest: int, slack: float, k: int
) -> DataFrame:
    """For each occupied cube of the points, all sites that can be among the k nearest."""
    near = around.join(places, _CUBE).selectExpr(
        *_OWN, "_site", f"{chord('_site.site_lat', '_site.site_lon', finest)} AS _chord"
    )
    if k == 1:
        best = near.groupBy(*_OWN).agg(F.min("_chord").alias("_best"))
        bounded = near.join(best, _OWN)
    else:
        cube = Window.partitionBy(*_OWN)
        number = F.row_number().over(cube.orderBy("_chord"))
        bounded = near.withColumn("_number", number).withColumn(
            "_best", F.max(F.when(F.col("_number") <= k, F.col("_chord"))).over(cube)
        )
    return bounded.where(can_win(finest, slack)).select(*_OWN, "_site")


def _crowded_pairs(
    points: DataFrame, sites: DataFrame, crowded: DataFrame, finest: int, k: int, model: str
) -> DataFrame:
    """Pairs for the points whose 27 cubes hold many sites, by branch and bound."""
    # A written table of cubes is far smaller than its rows in memory.
    cubes = crowded.select(*_OWN).distinct().hint("merge")
    far = descent.written(
        points.selectExpr("*", *own_cube("lat", "lon", finest))
        .join(cubes, _OWN, "left_semi")
        .select(*points.columns),
        "crowded-points",
    )
    seeds = descent.written(
        crowded.selectExpr(
            "_level AS level",
            *[
                f"shiftright({own}, {finest} - _level) AS {p}"
                for own, p in zip(_OWN, descent.P_CUBE)
            ],
            *[f"{c} AS {s}" for c, s in zip(_CUBE[1:], descent.S_CUBE)],
        ).distinct(),
        "seeds",
    )
    settled = descent.settle(seeds, far.select("lat", "lon").distinct(), sites, k, model)
    return descent.compared(far, sites, settled)


def nearest_sites(
    points: DataFrame,
    sites: DataFrame,
    model: str = "geodesic",
    ties: str = "all",
    finest_level: int | None = None,
    k: int = 1,
) -> DataFrame:
    """Every point with its ``k`` nearest sites and the column ``distance_km``.

    ``points`` need ``lat`` and ``lon``, ``sites`` need ``site_lat`` and
    ``site_lon``; other columns are carried along under names that differ.
    Rows without a valid location are dropped.  ``ties='all'`` repeats a point
    for all sites whose rank by distance is at most ``k``; ``ties='first'``
    keeps ``k`` sites, among equally near ones those that sort first by their
    columns.  Where there are fewer sites than ``k``, a point has all of them.
    For ``k`` above 1 the column ``position`` holds the rank or number.

    Each location should occur a bounded number of times: aggregate first, or
    use :func:`nearest_sites_per_row`.  The points are read twice; the heavy
    part runs once if it ends in a shuffle that Spark can reuse.

    ``finest_level`` sets the size of the smallest cubes.  It only affects the
    speed; if it is not given, the sites are counted for it, and where there
    are many, points whose cubes hold a crowd are found by jobs that run here
    and are searched by branch and bound (see :mod:`~.descent`).
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    points = points.where("abs(lat) <= 90 AND lon BETWEEN -1e9 AND 1e9")
    sites = sites.where("abs(site_lat) <= 90 AND site_lon BETWEEN -1e9 AND 1e9")
    if ties == "first":
        sites = sites.distinct()
    n_sites = sites.count() if finest_level is None or k > 1 else None
    if n_sites is not None:
        k = max(1, min(k, n_sites))
    rows, many = points, k > 1
    if many:
        # A rank counts sites, so a place stands once.
        points = points.select("lat", "lon").distinct()
    finest = finest_level_for(n_sites) if finest_level is None else finest_level
    cubes = points.selectExpr(*own_cube("lat", "lon", finest)).distinct()
    places = _places(sites, finest)
    large = n_sites is None or n_sites * (finest + 1) > MOST_PLACED
    # All points share the cubes of the first levels.
    join = split_join if large and n_sites is not None else DataFrame.join
    if large:
        places = places.hint("merge")
    around = _around(cubes, places, finest, k, join)
    crowded = None
    if n_sites is not None and n_sites > CROWD:
        counts = places.groupBy(*_CUBE).agg(F.count("*").alias("_n"))
        total = F.sum("_n").over(Window.partitionBy(*_OWN))
        around = descent.written(
            join(around, counts, _CUBE).select(*_OWN, *_CUBE, total.alias("_total")), "around"
        )
        crowded = around.where(F.col("_total") > CROWD)
        around = around.where(F.col("_total") <= CROWD).drop("_total")
    placed = points.selectExpr("*", *own_cube("lat", "lon", finest))
    pairs = (
        (placed.hint("merge") if large else placed)
        .join(_candidates(around, places, finest, slack(model), k), _OWN)
        .select(*points.columns, "_site")
    )
    if crowded is not None and not crowded.isEmpty():
        pairs = pairs.unionByName(_crowded_pairs(points, sites, crowded, finest, k, model))
    pairs = pairs.select(*points.columns, "_site.*").withColumn(
        "distance_km", distance_km("lat", "lon", "site_lat", "site_lon", model)
    )
    order = [F.col("distance_km").asc_nulls_last()]
    if ties == "first":
        order += [F.col(c) for c in sites.columns]
    ranked = top_per_group(pairs, ["lat", "lon"], order, k, "all")
    if not many:
        return ranked.drop("position")
    return rows.join(ranked, ["lat", "lon"]).select(
        *rows.columns, *sites.columns, "distance_km", "position"
    )


def nearest_sites_per_row(
    points: DataFrame,
    sites: DataFrame,
    model: str = "geodesic",
    ties: str = "all",
    key: list[str] | None = None,
    finest_level: int | None = None,
) -> DataFrame:
    """:func:`nearest_sites` for raw rows, however often a location repeats.

    Distances are found once per location and joined back.  With a ``key``,
    rows that share it compete and only the nearest pair of each key is kept,
    as in a rank per incident number.  Equal rows are counted before they
    compete and repeated afterwards.
    """
    if key is None:
        spots = points.select("lat", "lon").distinct()
        found = nearest_sites(spots, sites, model, ties, finest_level)
        return points.join(found, ["lat", "lon"]).select(
            *points.columns, *sites.columns, "distance_km"
        )
    times = "_times"
    while times in (*points.columns, *sites.columns):
        times = "_" + times
    counted = points.groupBy(*points.columns).agg(F.count("*").alias(times))
    kept = nearest_of_key(counted.where(F.col(times) > 0), sites, key, model, ties, finest_level)
    if ties == "first":
        return kept.drop(times)
    again = F.explode(F.array_repeat(F.lit(0), F.col(times).cast("int"))).alias("_again")
    return kept.select("*", again).drop(times, "_again")


def nearest_of_key(
    counted: DataFrame,
    sites: DataFrame,
    key: list[str],
    model: str = "geodesic",
    ties: str = "all",
    finest_level: int | None = None,
) -> DataFrame:
    """The nearest pairs of each key, for rows without repetitions."""
    spots = counted.groupBy("lat", "lon").agg(F.count("*").alias("_rows"))
    found = nearest_sites(spots.drop("_rows"), sites, model, ties, finest_level)
    pairs = counted.join(found, ["lat", "lon"]).select(
        *counted.columns, *sites.columns, "distance_km"
    )
    return keep_nearest(pairs, key, ties)


def keep_nearest(pairs: DataFrame, key: list[str], ties: str = "all") -> DataFrame:
    """The nearest pairs of each key, as ``rank() = 1`` over the key would keep.

    With ``ties='all'`` the rank filter sits on its window: every task keeps the
    nearest rows of a key and those tied with them, and only these meet, so a
    key with a large part of all rows is cut before the shuffle.  Rows that are
    equal altogether should be counted first.
    """
    if ties == "first":
        others = [c for c in pairs.columns if c not in key]
        distance = F.coalesce("distance_km", F.lit(float("inf")))
        first = F.min(F.struct(distance, F.struct(*others).alias("_pair"))).alias("_first")
        return pairs.groupBy(*key).agg(first).select(*key, "_first._pair.*").select(pairs.columns)
    name = "_position"
    while name in pairs.columns:
        name = "_" + name
    nearest = [F.col("distance_km").asc_nulls_last()]
    return top_per_group(pairs, key, nearest, 1, name=name).drop(name)

"""Nearest sites by two-sided branch and bound over cubes.

For points that lie far from crowded sites no fixed ring of cubes is small: it
holds either no site or all of them.  Here pairs (point cube, site cube) are
refined on both sides, one level a round.  A cube is described by a ball
around the box of its members, in kilometres of the distance model itself.  As
that distance obeys the triangle inequality, all distances between the members
of two cubes lie between that of the centres less both radii and that plus
both radii.  The k-th smallest upper bound, every site cube counting for all of
its sites, is a distance that each point's k nearest sites are within: site
cubes whose lower bound is beyond it go.  A point cube with few sites left
leaves the search; its points are compared with these.

A single member is a ball of radius 0, so bounds become distances in the end.
Rounds are written to the shared folder; all steps are joins on (level, cube).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatmetrics.functions.distance import (
    EARTH_RADIUS_KM,
    WGS84_FLATTENING,
    WGS84_MAJOR_KM,
    distance_km,
)
from beatmetrics.operators.skew import split_join
from beatmetrics.sources.scratch import scratch_path

# Sites that a point is compared with one by one.
FEW = 64
# Pairs of a round beyond which frequent site cubes are split.
MANY = 1_000_000
# Pairs of a round that may be broadcast; a written table tells too little of its rows.
MOST_BROADCAST = 100_000
# Edges at the last level are about a metre long.
LAST_LEVEL = 24
# Kilometres by which computed distances may be off.
TOLERANCE_KM = 1e-5
# The widest radius of curvature, so that angles times it are no shorter than distances.
WIDEST_KM = {
    "geodesic": WGS84_MAJOR_KM / (1 - WGS84_FLATTENING),
    "haversine": EARTH_RADIUS_KM,
}

P_CUBE = ["px", "py", "pz"]
S_CUBE = ["sx", "sy", "sz"]
FRONTIER = ["level", *P_CUBE, *S_CUBE]


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unit(lat: str, lon: str) -> list[str]:
    """The place as a point of the unit sphere."""
    return [
        f"cos(radians({lat})) * cos(radians({lon}))",
        f"cos(radians({lat})) * sin(radians({lon}))",
        f"sin(radians({lat}))",
    ]


def last_cube(lat: str, lon: str) -> list[str]:
    """Columns ``_x _y _z``: the cube of the last level."""
    top = 2**LAST_LEVEL
    return [
        f"least(cast(floor(({v} + 1e0) * {top // 2}e0) AS int), {top - 1}) AS _{axis}"
        for v, axis in zip(unit(lat, lon), "xyz")
    ]


def up_to(level: str, names: list[str]) -> list[str]:
    """The cube around the last one at a level."""
    return [
        f"shiftright(_{axis}, {LAST_LEVEL} - {level}) AS {name}" for axis, name in zip("xyz", names)
    ]


def tree(places: DataFrame, lat: str, lon: str, names: list[str], model: str) -> DataFrame:
    """Rows (level, cube, n, centre, radius): every occupied cube below the first level.

    The centre is that of the members' box, or the member itself.
    """
    placed = places.selectExpr(
        f"{lat} AS lat",
        f"{lon} AS lon",
        *[f"{v} AS u{axis}" for v, axis in zip(unit(lat, lon), "xyz")],
        *last_cube(lat, lon),
        f"explode(sequence(1, {LAST_LEVEL})) AS level",
    ).selectExpr("*", *up_to("level", names))
    ends = [
        f(c).alias(f"{f.__name__}_{c}")
        for c in ("lat", "lon", "ux", "uy", "uz")
        for f in (F.min, F.max)
    ]
    boxes = placed.groupBy("level", *names).agg(F.count(F.lit(1)).alias("n"), *ends)
    middle = {a: f"(min_u{a} + max_u{a}) / 2" for a in "xyz"}
    half = " + ".join(f"power((max_u{a} - min_u{a}) / 2, 2)" for a in "xyz")
    norm = "sqrt(" + " + ".join(f"power({m}, 2)" for m in middle.values()) + ")"
    single = "min_lat = max_lat AND min_lon = max_lon"
    # From the centre, brought to the sphere, to a corner of the box.
    reach = f"(sqrt({half}) + abs(1e0 - {norm}))"
    angle = f"2e0 * asin(least(1e0, {reach} / 2e0))"
    return boxes.selectExpr(
        "level",
        *names,
        "n",
        f"CASE WHEN {single} THEN min_lat ELSE degrees(atan2({middle['z']}, "
        f"sqrt(power({middle['x']}, 2) + power({middle['y']}, 2)))) END AS lat",
        f"CASE WHEN {single} THEN min_lon ELSE degrees(atan2({middle['y']}, {middle['x']})) END"
        " AS lon",
        f"CASE WHEN {single} THEN 0e0 ELSE {WIDEST_KM[model]!r}D * {angle} * 1.000000001D END"
        " AS radius",
    )


def refine(
    frontier: DataFrame, point_tree: DataFrame, site_tree: DataFrame, k: int, model: str
) -> DataFrame:
    """The pairs one level below, with bounds; ``kept`` marks those within the cut."""

    # At most one of each level.
    met = frontier.agg(
        F.count(F.lit(1)).alias("pairs"), F.collect_set("level").alias("levels")
    ).first()

    def children(cubes: DataFrame, names: list[str], prefix: str) -> DataFrame:
        below = cubes.where(F.col("level").isin([level + 1 for level in met.levels])).select(
            (F.col("level") - 1).alias("level"),
            *[F.shiftright(c, 1).alias(c) for c in names],
            *[F.col(c).alias(f"next_{c}") for c in names],
            *[F.col(c).alias(f"{prefix}_{c}") for c in ("n", "lat", "lon", "radius")],
        )
        return below.hint("merge") if met.pairs > MOST_BROADCAST else below

    # The site cubes at the edge of a crowd may be paired with all point cubes.
    join = split_join if met.pairs > MANY else DataFrame.join
    pairs = (
        join(frontier.select(*FRONTIER), children(site_tree, S_CUBE, "s"), ["level", *S_CUBE])
        .join(children(point_tree, P_CUBE, "p"), ["level", *P_CUBE])
        .select(
            (F.col("level") + 1).alias("level"),
            *[F.col(f"next_{c}").alias(c) for c in (*P_CUBE, *S_CUBE)],
            F.col("s_n").alias("n"),
            distance_km("p_lat", "p_lon", "s_lat", "s_lon", model).alias("centres"),
            (F.col("p_radius") + F.col("s_radius") + TOLERANCE_KM).alias("slack"),
        )
        .withColumn("upper", F.col("centres") + F.col("slack"))
    )
    cube = Window.partitionBy("level", *P_CUBE)
    rising = cube.orderBy("upper", *S_CUBE).rowsBetween(Window.unboundedPreceding, 0)
    return (
        pairs.withColumn("within", F.sum("n").over(rising))
        .withColumn("cut", F.min(F.when(F.col("within") >= k, F.col("upper"))).over(cube))
        .withColumn("kept", F.col("centres") - F.col("slack") <= F.col("cut"))
    )


def few_left(refined: DataFrame, few: int) -> DataFrame:
    """The kept pairs, with ``settled`` where the point cube has few sites left."""
    total = F.sum("n").over(Window.partitionBy("level", *P_CUBE))
    return refined.where("kept").select(
        *FRONTIER, ((total <= few) | (F.col("level") == LAST_LEVEL)).alias("settled")
    )


def settle(
    seeds: DataFrame,
    points: DataFrame,
    sites: DataFrame,
    k: int,
    model: str,
    few: int = FEW,
) -> DataFrame:
    """The pairs (level, point cube, site cube) whose members are to be compared.

    ``seeds`` are pairs of cubes of any levels such that each point's k nearest
    sites lie in the site cubes paired with one of its cubes, all of one level.
    ``points`` are distinct places lat, lon; ``sites`` rows site_lat, site_lon.
    """
    point_tree = written(tree(points, "lat", "lon", P_CUBE, model), "point-cubes")
    site_tree = written(tree(sites, "site_lat", "site_lon", S_CUBE, model), "site-cubes")
    seeds = outermost(seeds)
    done, frontier = [], seeds
    while not frontier.isEmpty():
        found = written(few_left(refine(frontier, point_tree, site_tree, k, model), few), "pairs")
        done.append(found.where("settled").select(*FRONTIER))
        frontier = found.where("NOT settled")
    return reduce(DataFrame.unionAll, done) if done else seeds


def outermost(seeds: DataFrame) -> DataFrame:
    """The seeds without those whose point cube lies in that of a coarser seed."""
    cubes = seeds.select("level", *P_CUBE).distinct().hint("merge")
    inside = (
        cubes.where("level > 0")
        .selectExpr("*", "explode(sequence(0, level - 1)) AS outer")
        .selectExpr(
            "level AS own",
            *[f"{c} AS own_{c}" for c in P_CUBE],
            "outer AS level",
            *[f"shiftright({c}, level - outer) AS {c}" for c in P_CUBE],
        )
        .join(cubes, ["level", *P_CUBE], "left_semi")
        .selectExpr("own AS level", *[f"own_{c} AS {c}" for c in P_CUBE])
    )
    return seeds.join(inside.hint("merge"), ["level", *P_CUBE], "left_anti")


def compared(points: DataFrame, sites: DataFrame, settled: DataFrame) -> DataFrame:
    """Rows of the points' columns and the struct ``_site``, for the members of settled pairs."""
    # At most one row per level.
    levels = sorted(r.level for r in settled.select("level").distinct().collect())
    each = f"explode(array({', '.join(map(str, levels))})) AS level"
    placed_points = points.selectExpr("struct(*) AS _point", *last_cube("lat", "lon"), each)
    placed_sites = sites.selectExpr("struct(*) AS _site", *last_cube("site_lat", "site_lon"), each)
    return (
        placed_points.selectExpr("_point", "level", *up_to("level", P_CUBE))
        .join(settled.hint("merge"), ["level", *P_CUBE])
        .join(
            placed_sites.selectExpr("_site", "level", *up_to("level", S_CUBE)).hint("merge"),
            ["level", *S_CUBE],
        )
        .select("_point.*", "_site")
    )

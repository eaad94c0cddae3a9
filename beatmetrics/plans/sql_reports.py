"""The incident reports as Spark SQL.

Each function hands its tables to ``spark.sql`` as DataFrames, so no view name
is taken in the caller's session.  :func:`register_views` is there for callers
who want to write their own SQL over named views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beatmetrics.functions.distance import register_functions
from beatmetrics.operators import nearest as grid


def register_views(**tables: DataFrame) -> None:
    """Names the tables for SQL: ``register_views(incidents=df, stations=df)``."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


TOP_PERIODS = """
    WITH months AS (
      SELECT year(date_occ) AS year, month(date_occ) AS month, count(*) AS incidents
      FROM {incidents}
      GROUP BY ALL
    ), ranked AS (
      SELECT *, rank() OVER (PARTITION BY year ORDER BY incidents DESC) AS position
      FROM months
    )
    SELECT year, month, incidents, position
    FROM ranked
    WHERE position <= :n
    ORDER BY year, position, month
"""

DAY_SEGMENTS = """
    SELECT day_segment, count(*) AS incidents
    FROM (
      SELECT day_segment(time_occ) AS day_segment
      FROM {incidents}
      WHERE premise = :premise
    )
    GROUP BY day_segment
    ORDER BY incidents DESC, day_segment
"""

VICTIMS_BY_ZIP = """
    SELECT zip, median_income, victim_descent, sum(incidents) AS incidents
    FROM (
      SELECT lat, lon, victim_descent, count(*) AS incidents
      FROM {incidents}
      WHERE date_occ >= make_date(:year, 1, 1) AND date_occ < make_date(:year + 1, 1, 1)
        AND victim_age <> 0 AND victim_descent <> 'X'
      GROUP BY ALL)
    JOIN {geozip} USING (lat, lon)
    JOIN {incomes} USING (zip)
    GROUP BY zip, median_income, victim_descent
    HAVING sum(incidents) > 0
"""

INCOME_EXTREMES = """
    WITH pairs AS (SELECT DISTINCT zip, median_income FROM {by_zip})
    SELECT zip FROM (
      SELECT * FROM pairs ORDER BY median_income DESC NULLS LAST, zip LIMIT :n)
    UNION
    SELECT zip FROM (
      SELECT * FROM pairs ORDER BY median_income ASC NULLS FIRST, zip LIMIT :n)
"""

VICTIM_GROUPS = """
    SELECT victim_descent, sum(incidents) AS incidents
    FROM {by_zip} LEFT SEMI JOIN {chosen} USING (zip)
    GROUP BY victim_descent
    ORDER BY incidents DESC, victim_descent
"""

FIREARMS_BY_YEAR = """
    SELECT lat, lon, area_code, year(date_occ) AS year, 1 AS incidents
    FROM {incidents}
    WHERE weapon_code LIKE '1__' AND lat <> 0 AND lon <> 0
"""

WEAPONS_BY_AREA = """
    SELECT lat, lon, area_code, 1 AS incidents
    FROM {incidents}
    WHERE weapon_code IS NOT NULL AND lat <> 0 AND lon <> 0
"""

ASSIGNED = """
    SELECT i.*, s.division, s.lat AS site_lat, s.lon AS site_lon, 1 AS site_count,
      geodesic_km(i.lat, i.lon, site_lat, site_lon) AS distance_km
    FROM {located} i
    JOIN {stations} s ON try_cast(i.area_code AS INT) = s.prec
"""

MEAN = """round(try_divide(sum(distance_km * incidents * site_count),
        sum(incidents * site_count) FILTER (WHERE distance_km IS NOT NULL)), 3)
        AS avg_distance_km,
      sum(incidents * site_count) AS incidents"""

MEAN_BY_YEAR = f"""
    SELECT year, {MEAN}
    FROM {{pairs}}
    GROUP BY year
    ORDER BY year
"""

MEAN_BY_DIVISION = f"""
    SELECT division, {MEAN}
    FROM {{pairs}}
    GROUP BY division
    ORDER BY 3 DESC, division
"""


# Cubes of 800 m; the size only affects the speed.
FINEST = 14
OWN = ", ".join(grid._OWN)
CUBE = ", ".join(grid._CUBE)


def nearest_statement(where: str, place_group: str, site_group: str, order: str) -> str:
    """The nearest search and its report as one statement.

    The expressions table by table are the steps of
    :mod:`beatmetrics.operators.nearest`: cubes of the places, the level on
    which the cube around holds a station, the stations of the 27 cubes there,
    those that can win, and the rank of what is left by the real distance.
    Groups are the names of a column of the places or the stations, or empty.
    """
    places = f"lat, lon, {place_group}".rstrip(", ")
    stations = f"site_lat, site_lon, {site_group}".rstrip(", ")
    named = f"lat AS site_lat, lon AS site_lon, {site_group}".rstrip(", ")
    group = (place_group or site_group).split(" AS ")[-1]
    kept = f"lat, lon, {place_group.split(' AS ')[-1]}".rstrip(", ")
    return f"""
    WITH spots AS (
      SELECT {places}, count(*) AS incidents
      FROM {{incidents}}
      WHERE {where} AND lat <> 0 AND lon <> 0
      GROUP BY ALL
      HAVING count(*) > 0
    ), sites AS (
      SELECT {named}, count(*) AS site_count
      FROM {{stations}}
      WHERE abs(lat) <= 90 AND lon IS NOT NULL
      GROUP BY ALL
    ), located AS (
      SELECT *, {", ".join(grid.own_cube("lat", "lon", FINEST))}
      FROM spots
      WHERE abs(lat) <= 90 AND lon IS NOT NULL
    ), cubes AS (
      SELECT DISTINCT {OWN} FROM located
    ), levelled AS (
      SELECT *, {", ".join(grid.own_cube("site_lat", "site_lon", FINEST))}, {grid.levels(FINEST)}
      FROM sites
    ), placed AS (
      SELECT {stations}, site_count, _level, {", ".join(grid.around_own(FINEST))} FROM levelled
    ), holding AS (
      SELECT DISTINCT {CUBE} FROM placed
    ), reach AS (
      SELECT {OWN}, greatest(max(_level) - 1, 0) AS _level
      FROM (SELECT {OWN}, _level, {", ".join(grid.around_own(FINEST))}
        FROM (SELECT {OWN}, {grid.levels(FINEST)} FROM cubes))
      JOIN holding USING ({CUBE})
      GROUP BY {OWN}
    ), around AS (
      SELECT {OWN}, _level, {", ".join(grid.neighbours(FINEST))}
      FROM (SELECT *, explode(sequence(0, 26)) AS _n FROM reach)
    ), near AS (
      SELECT {OWN}, {stations}, site_count, {grid.chord("site_lat", "site_lon", FINEST)} AS _chord
      FROM around JOIN placed USING ({CUBE})
    ), best AS (
      SELECT {OWN}, min(_chord) AS _best FROM near GROUP BY {OWN}
    ), candidates AS (
      SELECT {OWN}, {stations}, site_count
      FROM near JOIN best USING ({OWN})
      WHERE {grid.can_win(FINEST, grid.slack("geodesic"))}
    ), measured AS (
      SELECT {kept}, {stations}, incidents, site_count,
        geodesic_km(lat, lon, site_lat, site_lon) AS distance_km
      FROM located JOIN candidates USING ({OWN})
    ), ranked AS (
      SELECT *, rank() OVER (PARTITION BY lat, lon ORDER BY distance_km ASC NULLS LAST) AS position
      FROM measured
    )
    SELECT {group}, {MEAN}
    FROM ranked
    WHERE position <= 1
    GROUP BY {group}
    ORDER BY {order}
    """


FIREARM_NEAREST = nearest_statement(
    "weapon_code LIKE '1__'", "year(date_occ) AS year", "", "year"
)
WEAPON_NEAREST = nearest_statement("weapon_code IS NOT NULL", "", "division", "3 DESC, division")


def top_periods(spark: SparkSession, incidents: DataFrame, n: int = 3) -> DataFrame:
    return spark.sql(TOP_PERIODS, args={"n": n}, incidents=incidents)


def incidents_by_day_segment(
    spark: SparkSession, incidents: DataFrame, premise: str = "STREET"
) -> DataFrame:
    register_functions(spark)
    return spark.sql(DAY_SEGMENTS, args={"premise": premise}, incidents=incidents)


def victim_groups_by_income_extremes(
    spark: SparkSession,
    incidents: DataFrame,
    geozip: DataFrame,
    incomes: DataFrame,
    year: int = 2015,
    n: int = 3,
) -> DataFrame:
    by_zip = spark.sql(
        VICTIMS_BY_ZIP,
        args={"year": year},
        incidents=incidents,
        geozip=geozip,
        incomes=incomes.select("zip", "median_income"),
    )
    chosen = spark.sql(INCOME_EXTREMES, args={"n": n}, by_zip=by_zip)
    return spark.sql(VICTIM_GROUPS, by_zip=by_zip, chosen=chosen)


def _assigned(spark, statement, mean, incidents, stations) -> DataFrame:
    register_functions(spark)
    located = spark.sql(statement, incidents=incidents)
    pairs = spark.sql(ASSIGNED, located=located, stations=stations)
    return spark.sql(mean, pairs=pairs)


def assigned_station_by_year(
    spark: SparkSession, incidents: DataFrame, stations: DataFrame
) -> DataFrame:
    return _assigned(spark, FIREARMS_BY_YEAR, MEAN_BY_YEAR, incidents, stations)


def assigned_station_report(
    spark: SparkSession, incidents: DataFrame, stations: DataFrame
) -> DataFrame:
    return _assigned(spark, WEAPONS_BY_AREA, MEAN_BY_DIVISION, incidents, stations)


def nearest_station_by_year(
    spark: SparkSession, incidents: DataFrame, stations: DataFrame
) -> DataFrame:
    """One statement, the search included."""
    register_functions(spark)
    return spark.sql(FIREARM_NEAREST, incidents=incidents, stations=stations)


def nearest_station_report(
    spark: SparkSession, incidents: DataFrame, stations: DataFrame
) -> DataFrame:
    """One statement, the search included."""
    register_functions(spark)
    return spark.sql(WEAPON_NEAREST, incidents=incidents, stations=stations)

"""One named query per operator, over the given parquet tables.

``QUERIES`` maps a name to a function of (session, folder); ``ORACLES`` maps it
to plain SQL with the same result.  Oracle text sees the derived views as
common table expressions in front.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beatmetrics.functions import columns as fc
from beatmetrics.functions.distance import with_distance_km
from beatmetrics.operators import selection
from beatmetrics.operators.hints import STRATEGIES
from beatmetrics.operators.nearest import nearest_sites, nearest_sites_per_row
from beatmetrics.operators.plans import compare_plans
from beatmetrics.operators.positions import global_positions
from beatmetrics.plans import reports, sql_reports
from beatmetrics.sources import readers, schemas, writers
from beatmetrics.sources.derived import VIEWS, load
from beatmetrics.sources.scratch import scratch_path

REPORT_YEAR = 1999

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def views_sql(*names: str) -> str:
    return ",\n".join(f"{name} AS ({VIEWS[name].format(text='varchar')})" for name in names)


def _query(oracle: str | None = None, views: tuple[str, ...] = ()):
    """Registers a query under the name of its function."""

    def register(build):
        QUERIES[build.__name__] = build
        if oracle is not None:
            text = oracle.strip()
            ctes = [views_sql(*views)] if views else []
            if text.upper().startswith("WITH "):
                ctes.append(text[5:])
                ORACLES[build.__name__] = "WITH " + ",\n".join(ctes)
            else:
                ORACLES[build.__name__] = ("WITH " + ctes[0] + "\n" if ctes else "") + text
        return build

    return register


def _incidents(spark, sf) -> DataFrame:
    return load(spark, sf, "incidents")


def _stations(spark, sf) -> DataFrame:
    return load(spark, sf, "stations")


def _geozip(spark, sf) -> DataFrame:
    return load(spark, sf, "geozip_raw").select(
        "lat", "lon", fc.zip_prefix("zip_raw").alias("zip")
    )


def _incomes(spark, sf) -> DataFrame:
    return load(spark, sf, "incomes_raw").select(
        "zip", "community", fc.parse_money("income_raw").alias("median_income")
    )


GEOZIP_SQL = "geozip AS (SELECT lat, lon, split_part(zip_raw, '-', 1) AS zip FROM geozip_raw)"
INCOMES_SQL = """incomes AS (SELECT zip, community,
    try_cast(replace(replace(income_raw, '$', ''), ',', '') AS int) AS median_income
    FROM incomes_raw)"""

SEGMENT_SQL = """CASE
    WHEN try_cast(substr(time_occ, 1, 2) AS int) IS NULL THEN 'UNKNOWN'
    WHEN try_cast(substr(time_occ, 1, 2) AS int) IN (5, 6, 7, 8, 9, 10, 11) THEN 'MORNING'
    WHEN try_cast(substr(time_occ, 1, 2) AS int) IN (12, 13, 14, 15, 16) THEN 'AFTERNOON'
    WHEN try_cast(substr(time_occ, 1, 2) AS int) IN (17, 18, 19, 20) THEN 'EVENING'
    ELSE 'NIGHT' END"""


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"""2 * 6371.0088e0 * asin(sqrt(least(1e0,
        pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))
        * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"""


def geodesic_ctes(source: str, steps: int = 8) -> str:
    """Common table expressions that add ``distance_km`` to ``source``.

    Vincenty's inverse with a fixed number of steps, one per expression; the
    distances of a city settle after four.  ``source`` has lat, lon, site_lat,
    site_lon; the result is called ``measured``.
    """
    f = "(1e0 / 298.257223563e0)"
    parts = [
        f"""v0 AS (SELECT *, radians(site_lon - lon) AS span, radians(site_lon - lon) AS lam,
          sin(atan((1 - {f}) * tan(radians(lat)))) AS su1,
          cos(atan((1 - {f}) * tan(radians(lat)))) AS cu1,
          sin(atan((1 - {f}) * tan(radians(site_lat)))) AS su2,
          cos(atan((1 - {f}) * tan(radians(site_lat)))) AS cu2 FROM {source})"""
    ]
    arc = """sqrt(pow(cu2 * sin(lam), 2) + pow(cu1 * su2 - su1 * cu2 * cos(lam), 2)) AS ss,
          su1 * su2 + cu1 * cu2 * cos(lam) AS cs"""
    keep = "EXCLUDE (ss, cs, sa, ca, cm, lam)"
    for i in range(steps + 1):
        parts.append(f"a{i} AS (SELECT *, {arc} FROM v{i})")
        parts.append(
            f"""b{i} AS (SELECT *, CASE WHEN ss = 0 THEN 0e0 ELSE cu1 * cu2 * sin(lam) / ss END
              AS sa FROM a{i})"""
        )
        parts.append(f"c{i} AS (SELECT *, 1 - sa * sa AS ca FROM b{i})")
        parts.append(
            f"""d{i} AS (SELECT *, CASE WHEN ca < 1e-15 THEN 0e0 ELSE cs - 2 * su1 * su2 / ca END
              AS cm FROM c{i})"""
        )
        if i < steps:
            c = f"({f} / 16 * ca * (4 + {f} * (4 - 3 * ca)))"
            parts.append(
                f"""v{i + 1} AS MATERIALIZED (SELECT * {keep}, span + (1 - {c}) * {f} * sa * (atan2(ss, cs)
                  + {c} * ss * (cm + {c} * cs * (2 * cm * cm - 1))) AS lam FROM d{i})"""
            )
    b = f"(6378.137e0 * (1 - {f}))"
    parts.append(
        f"""u AS (SELECT *, ca * (pow(6378.137e0, 2) - pow({b}, 2)) / pow({b}, 2) AS usq
          FROM d{steps})"""
    )
    parts.append(
        """w AS (SELECT *,
          1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq))) AS wa,
          usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq))) AS wb FROM u)"""
    )
    parts.append(
        f"""measured AS (SELECT *, {b} * wa * (atan2(ss, cs) - wb * ss * (cm + wb / 4 * (
          cs * (2 * cm * cm - 1) - wb / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3))))
          AS distance_km FROM w)"""
    )
    return ",\n".join(parts)


# --- Reports -----------------------------------------------------------------

TOP_MONTHS = """
WITH months AS (SELECT cast(year(date_occ) AS int) AS year, cast(month(date_occ) AS int) AS month,
    count(*) AS incidents FROM incidents GROUP BY 1, 2),
  ranked AS (SELECT *, cast({rank} AS int) AS position FROM months)
SELECT year, month, incidents, position FROM ranked WHERE position <= 3"""
TOP_MONTHS_RANK = TOP_MONTHS.format(
    rank="rank() OVER (PARTITION BY year ORDER BY incidents DESC)"
)
TOP_MONTHS_ROWNUM = TOP_MONTHS.format(
    rank="row_number() OVER (PARTITION BY year ORDER BY incidents DESC, month)"
)
DAY_SEGMENTS = f"""
SELECT {SEGMENT_SQL} AS day_segment, count(*) AS incidents
FROM incidents WHERE premise = 'STREET' GROUP BY 1"""

EXTREMES = f"""
WITH {GEOZIP_SQL}, {INCOMES_SQL},
  joined AS (SELECT i.victim_descent, g.zip, n.median_income FROM incidents i
    JOIN geozip g ON i.lat = g.lat AND i.lon = g.lon JOIN incomes n ON g.zip = n.zip
    WHERE year(i.date_occ) = {REPORT_YEAR} AND i.victim_age IS NOT NULL AND i.victim_age <> 0
      AND i.victim_descent IS NOT NULL AND i.victim_descent <> 'X'),
  pairs AS (SELECT DISTINCT zip, median_income FROM joined),
  chosen AS (SELECT zip FROM (SELECT * FROM pairs
      ORDER BY median_income DESC NULLS LAST, zip LIMIT 3) top
    {{union}} SELECT zip FROM (SELECT * FROM pairs
      ORDER BY median_income ASC NULLS FIRST, zip LIMIT 3) bottom)
SELECT victim_descent, count(*) AS incidents
FROM joined JOIN chosen ON joined.zip = chosen.zip GROUP BY victim_descent"""
EXTREMES_DISTINCT = EXTREMES.format(union="UNION")
EXTREMES_ALL = EXTREMES.format(union="UNION ALL")
EXTREMES_VIEWS = ("incidents", "geozip_raw", "incomes_raw")

FIREARM = "weapon_code LIKE '1__' AND lat <> 0 AND lon <> 0"
WEAPON = "weapon_code IS NOT NULL AND lat <> 0 AND lon <> 0"
MEAN = "round(avg(distance_km), 3) AS avg_distance_km, count(*) AS incidents"
STATION_VIEWS = ("incidents", "stations")


def assigned_sql(where: str, group: str, measured: str) -> str:
    return f"""
WITH located AS (SELECT *, cast(year(date_occ) AS int) AS year FROM incidents WHERE {where}),
  assigned AS (SELECT l.year, l.lat, l.lon, s.division, s.lat AS site_lat, s.lon AS site_lon
    FROM located l JOIN stations s ON try_cast(l.area_code AS int) = s.prec),
  {measured}
SELECT {group}, {MEAN} FROM measured GROUP BY {group}"""


def nearest_sql(where: str, group: str, measured: str) -> str:
    return f"""
WITH located AS (SELECT *, cast(year(date_occ) AS int) AS year FROM incidents WHERE {where}),
  paired AS (SELECT l.incident_id, l.year, l.lat, l.lon, s.division,
    s.lat AS site_lat, s.lon AS site_lon FROM located l CROSS JOIN stations s),
  {measured},
  ranked AS (SELECT *, rank() OVER (PARTITION BY incident_id ORDER BY distance_km) AS position
    FROM measured)
SELECT {group}, {MEAN} FROM ranked WHERE position = 1 GROUP BY {group}"""


def haversine_cte(source: str) -> str:
    km = haversine_sql("lat", "lon", "site_lat", "site_lon")
    return f"measured AS (SELECT *, {km} AS distance_km FROM {source})"


FIREARM_ASSIGNED = assigned_sql(FIREARM, "year", geodesic_ctes("assigned"))
WEAPON_ASSIGNED = assigned_sql(WEAPON, "division", geodesic_ctes("assigned"))
FIREARM_NEAREST = nearest_sql(FIREARM, "year", geodesic_ctes("paired"))
WEAPON_NEAREST = nearest_sql(WEAPON, "division", geodesic_ctes("paired"))


@_query(TOP_MONTHS_RANK, ("incidents",))
def top_months_rank(spark, sf):
    return reports.top_periods(_incidents(spark, sf), 3, "all")


@_query(TOP_MONTHS_ROWNUM, ("incidents",))
def top_months_rownum(spark, sf):
    return reports.top_periods(_incidents(spark, sf), 3, "first")


@_query(DAY_SEGMENTS, ("incidents",))
def day_segments(spark, sf):
    return reports.incidents_by_day_segment(_incidents(spark, sf))


def _extremes(spark, sf, **options):
    return reports.victim_groups_by_income_extremes(
        _incidents(spark, sf), _geozip(spark, sf), _incomes(spark, sf), REPORT_YEAR, **options
    ).withColumn("incidents", F.col("incidents").cast("bigint"))


@_query(EXTREMES_DISTINCT, EXTREMES_VIEWS)
def income_extremes(spark, sf):
    return _extremes(spark, sf)


@_query(EXTREMES_ALL, EXTREMES_VIEWS)
def income_extremes_unionall(spark, sf):
    return _extremes(spark, sf, distinct_zips=False)


@_query(FIREARM_ASSIGNED, STATION_VIEWS)
def firearm_assigned_by_year(spark, sf):
    return reports.assigned_station_by_year(_incidents(spark, sf), _stations(spark, sf))


@_query(FIREARM_NEAREST, STATION_VIEWS)
def firearm_nearest_by_year(spark, sf):
    return reports.nearest_station_by_year(_incidents(spark, sf), _stations(spark, sf))


@_query(WEAPON_ASSIGNED, STATION_VIEWS)
def weapon_assigned_by_division(spark, sf):
    return reports.assigned_station_report(_incidents(spark, sf), _stations(spark, sf))


@_query(WEAPON_NEAREST, STATION_VIEWS)
def weapon_nearest_by_division(spark, sf):
    return reports.nearest_station_report(_incidents(spark, sf), _stations(spark, sf))


@_query(assigned_sql(FIREARM, "year", haversine_cte("assigned")), STATION_VIEWS)
def firearm_assigned_haversine(spark, sf):
    return reports.assigned_station_by_year(
        _incidents(spark, sf), _stations(spark, sf), model="haversine"
    )


@_query(nearest_sql(WEAPON, "division", haversine_cte("paired")), STATION_VIEWS)
def weapon_nearest_haversine(spark, sf):
    return reports.nearest_station_report(
        _incidents(spark, sf), _stations(spark, sf), model="haversine"
    )


@_query(FIREARM_NEAREST, STATION_VIEWS)
def firearm_nearest_per_incident_id(spark, sf):
    return reports.nearest_station_by_year(
        _incidents(spark, sf), _stations(spark, sf), key=["incident_id"]
    )


INCIDENT_TYPES = {
    "incident_id": "string",
    "date_occ": "timestamp_ntz",
    "time_occ": "string",
    "area_code": "string",
    "premise": "string",
    "weapon_code": "string",
    "victim_age": "int",
    "victim_descent": "string",
    "lat": "double",
    "lon": "double",
}


@_query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", '{kind}' AS "type", count(*) AS "rows",
        count(*) - count({name}) AS "nulls" FROM incidents"""
        for name, kind in INCIDENT_TYPES.items()
    ),
    ("incidents",),
)
def table_profile(spark, sf):
    return reports.profile(_incidents(spark, sf))


# --- Reports over odd values ---------------------------------------------------


def _odd(sql: str) -> str:
    for name in ("incidents", "geozip_raw", "incomes_raw"):
        odd = "odd_incidents" if name == "incidents" else f"few_{name}"
        sql = sql.replace(f"FROM {name}", f"FROM {odd}")
    return sql


ODD_EXTREMES_VIEWS = ("odd_incidents", "few_geozip_raw", "few_incomes_raw")


@_query(_odd(DAY_SEGMENTS), ("odd_incidents",))
def day_segments_unknown(spark, sf):
    """Times that cannot be read, and none at all."""
    return reports.incidents_by_day_segment(load(spark, sf, "odd_incidents"))


@_query(_odd(TOP_MONTHS_RANK), ("odd_incidents",))
def top_months_undated(spark, sf):
    """Incidents without a date are a year and a month of their own."""
    return reports.top_periods(load(spark, sf, "odd_incidents"), 3, "all")


@_query(_odd(FIREARM_NEAREST), ("odd_incidents", "stations"))
def firearm_nearest_repeated_ids(spark, sf):
    """A number at several places counts at the nearest of them."""
    return reports.nearest_station_by_year(
        load(spark, sf, "odd_incidents"), _stations(spark, sf), key=["incident_id"]
    )


def _odd_extremes(spark, sf, **options):
    geozip = load(spark, sf, "few_geozip_raw").select(
        "lat", "lon", fc.zip_prefix("zip_raw").alias("zip")
    )
    incomes = load(spark, sf, "few_incomes_raw").select(
        "zip", "community", fc.parse_money("income_raw").alias("median_income")
    )
    return reports.victim_groups_by_income_extremes(
        load(spark, sf, "odd_incidents"), geozip, incomes, REPORT_YEAR, **options
    )


@_query(_odd(EXTREMES_DISTINCT), ODD_EXTREMES_VIEWS)
def income_extremes_few_zips(spark, sf):
    """Four ZIP codes, so that some are on both lists, a null income, repeated income rows."""
    return _odd_extremes(spark, sf)


@_query(_odd(EXTREMES_ALL), ODD_EXTREMES_VIEWS)
def income_extremes_few_zips_unionall(spark, sf):
    return _odd_extremes(spark, sf, distinct_zips=False)


# --- The reports as SQL ------------------------------------------------------


@_query(TOP_MONTHS_RANK, ("incidents",))
def top_months_sql(spark, sf):
    return sql_reports.top_periods(spark, _incidents(spark, sf))


@_query(DAY_SEGMENTS, ("incidents",))
def day_segments_sql(spark, sf):
    return sql_reports.incidents_by_day_segment(spark, _incidents(spark, sf))


@_query(EXTREMES_DISTINCT, EXTREMES_VIEWS)
def income_extremes_sql(spark, sf):
    return sql_reports.victim_groups_by_income_extremes(
        spark, _incidents(spark, sf), _geozip(spark, sf), _incomes(spark, sf), REPORT_YEAR
    )


@_query(FIREARM_ASSIGNED, STATION_VIEWS)
def firearm_assigned_sql(spark, sf):
    return sql_reports.assigned_station_by_year(
        spark, _incidents(spark, sf), _stations(spark, sf)
    )


@_query(FIREARM_NEAREST, STATION_VIEWS)
def firearm_nearest_sql(spark, sf):
    return sql_reports.nearest_station_by_year(
        spark, _incidents(spark, sf), _stations(spark, sf)
    )


@_query(WEAPON_ASSIGNED, STATION_VIEWS)
def weapon_assigned_sql(spark, sf):
    return sql_reports.assigned_station_report(
        spark, _incidents(spark, sf), _stations(spark, sf)
    )


@_query(WEAPON_NEAREST, STATION_VIEWS)
def weapon_nearest_sql(spark, sf):
    return sql_reports.nearest_station_report(
        spark, _incidents(spark, sf), _stations(spark, sf)
    )


@_query(
    """SELECT * FROM (VALUES
      ('broadcast', 'BroadcastHashJoin', 'right', 1::BIGINT), ('merge', 'SortMergeJoin', NULL, 1),
      ('shuffle_hash', 'ShuffledHashJoin', 'right', 1)) AS t(strategy, node, build, nodes)"""
)
def assigned_plans(spark, sf):
    """The join of the assigned stations under the three hints, read from the plans."""
    stations = _stations(spark, sf)
    return compare_plans(
        spark,
        {
            strategy: reports.assigned_station_by_year(
                _incidents(spark, sf), stations, strategy=strategy
            )
            for strategy in STRATEGIES
        },
        "Join",
    )


@_query(
    """SELECT * FROM (VALUES
      ('broadcast', 'BroadcastHashJoin', 'right', 7::BIGINT), ('merge', 'SortMergeJoin', NULL, 7),
      ('shuffle_hash', 'ShuffledHashJoin', 'right', 7)) AS t(strategy, node, build, nodes)"""
)
def extremes_plans(spark, sf):
    """The joins of the income report under the three hints, read from the plans."""
    return compare_plans(
        spark,
        {strategy: _extremes(spark, sf, strategy=strategy) for strategy in STRATEGIES},
        "Join",
    )


# --- Sources and sinks -------------------------------------------------------


def _as_source_text(column: str) -> Column:
    """The text of a date as the incident files write it."""
    return F.date_format(column, fc.DATE_PATTERN)


def _csv_frame(df: DataFrame, schema, **columns) -> DataFrame:
    """Columns in file order; those without a value are empty."""
    return df.select(
        *[
            columns.get(f.name, F.lit(None).cast("string")).alias(f.name)
            for f in schema.fields
        ]
    )


@_query(
    """
    SELECT incident_id, cast(date_occ AS date) AS date_reported, cast(date_occ AS date) AS date_occ,
      time_occ, area_code, premise, weapon_code, victim_age, victim_descent,
      concat('Block ', area_code, ', "', premise, '"') AS address, lat, lon
    FROM incidents""",
    ("incidents",),
)
def csv_source(spark, sf):
    """Two incident files, written with quoted commas, read back as one table."""
    names = (
        "incident_id time_occ area_code premise weapon_code victim_age victim_descent lat lon"
    ).split()
    incidents = _incidents(spark, sf)
    columns = {name: F.col(name) for name in names}
    columns["date_occ"] = columns["date_reported"] = _as_source_text("date_occ")
    columns["address"] = F.concat(
        F.lit("Block "), F.col("area_code"), F.lit(', "'), F.col("premise"), F.lit('"')
    )
    before = F.coalesce(
        F.col("date_occ") < F.lit("1998-01-01").cast("timestamp_ntz"), F.lit(False)
    )
    paths = []
    for part in (before, ~before):
        paths.append(scratch_path(spark, "incidents"))
        writers.write_csv(
            _csv_frame(incidents.where(part), schemas.INCIDENTS, **columns), paths[-1]
        )
    return readers.read_incidents(spark, paths).select(
        "date_reported", "date_occ", "address", *names
    )


@_query(
    """SELECT unnest(['incident_id', 'date_occ', 'weapon_code', 'victim_age', 'no weapon'])
        AS "column", count(*) AS "rows",
      unnest([count(*) - count(incident_id), count(*) - count(date_occ),
        count(*) - count(weapon_code), count(*) - count(victim_age),
        count(*) - count(weapon_code)]) AS nulls
      FROM incidents""",
    ("incidents",),
)
def csv_sink_observed(spark, sf):
    """Counts of what a CSV sink wrote, from the job that wrote it."""
    incidents = _incidents(spark, sf).select(
        "incident_id", "date_occ", "weapon_code", "victim_age"
    )
    found = writers.write_csv_observed(
        incidents,
        scratch_path(spark, "observed"),
        rejected={"no weapon": F.col("weapon_code").isNull()},
    )
    return spark.createDataFrame(found, "column string, rows long, nulls long")


@_query(f"WITH {INCOMES_SQL} SELECT zip, community, median_income FROM incomes", ("incomes_raw",))
def csv_incomes(spark, sf):
    path = scratch_path(spark, "incomes")
    writers.write_csv(load(spark, sf, "incomes_raw"), path)
    return readers.read_incomes(spark, path)


@_query(f"WITH {GEOZIP_SQL} SELECT lat, lon, zip FROM geozip", ("geozip_raw",))
def csv_geozip(spark, sf):
    path = scratch_path(spark, "geozip")
    writers.write_csv(load(spark, sf, "geozip_raw"), path)
    return readers.read_geozip(spark, path)


@_query(
    "SELECT lon, lat, prec AS fid, division, concat(division, ' street') AS address, prec "
    "FROM stations",
    ("stations",),
)
def csv_stations(spark, sf):
    path = scratch_path(spark, "stations")
    stations = _stations(spark, sf)
    columns = {name: F.col(name) for name in ("lon", "lat", "division", "prec")}
    columns["fid"] = F.col("prec")
    columns["address"] = F.concat(F.col("division"), F.lit(" street"))
    writers.write_csv(_csv_frame(stations, schemas.STATIONS, **columns), path)
    return readers.read_stations(spark, path)


@_query(TOP_MONTHS_RANK, ("incidents",))
def csv_sink_roundtrip(spark, sf):
    path = scratch_path(spark, "top-months")
    months = reports.top_periods(_incidents(spark, sf))
    writers.write_csv(months, path)
    return spark.read.csv(path, header=True, schema=months.schema)


@_query(
    f"""
    WITH segments AS ({DAY_SEGMENTS})
    SELECT concat('(''', day_segment, ''', ', cast(incidents AS varchar), ')') AS value
    FROM segments""",
    ("incidents",),
)
def text_sink_roundtrip(spark, sf):
    path = scratch_path(spark, "day-segments")
    segments = reports.incidents_by_day_segment(_incidents(spark, sf))
    writers.write_pairs_text(segments, path, "day_segment", "incidents")
    return spark.read.text(path)


@_query("SELECT count(*) AS \"rows\" FROM lineitem")
def row_count(spark, sf):
    return load(spark, sf, "lineitem").agg(F.count("*").alias("rows"))


# --- Projections and filters -------------------------------------------------


@_query(
    """SELECT incident_id AS id, cast(year(date_occ) AS int) AS year, lat AS latitude,
      lon AS longitude FROM incidents""",
    ("incidents",),
)
def project_alias(spark, sf):
    return (
        _incidents(spark, sf)
        .withColumn("year", F.year("date_occ"))
        .withColumnsRenamed({"lat": "latitude", "lon": "longitude"})
        .selectExpr("incident_id AS id", "year", "latitude", "longitude")
    )


@_query(
    """SELECT prec, lat AS site_lat, lon AS site_lon, round(lat + lon, 6) AS coordinate_sum
      FROM stations""",
    ("stations",),
)
def lateral_alias(spark, sf):
    return spark.sql(
        """SELECT prec, lat AS site_lat, lon AS site_lon,
          round(site_lat + site_lon, 6) AS coordinate_sum FROM {stations}""",
        stations=_stations(spark, sf),
    )


@_query(
    "SELECT incident_id, premise FROM incidents WHERE premise = 'STREET'", ("incidents",)
)
def filter_eq(spark, sf):
    return (
        _incidents(spark, sf)
        .where(F.col("premise") == fc.STREET)
        .select("incident_id", "premise")
    )


@_query(
    f"""SELECT incident_id, cast(date_occ AS date) AS date_occ FROM incidents
      WHERE year(date_occ) = {REPORT_YEAR}""",
    ("incidents",),
)
def filter_year(spark, sf):
    return (
        _incidents(spark, sf)
        .where(fc.in_year("date_occ", REPORT_YEAR))
        .select("incident_id", F.col("date_occ").cast("date").alias("date_occ"))
    )


@_query(
    """SELECT incident_id, victim_age, victim_descent FROM incidents
      WHERE victim_age IS NOT NULL AND victim_age <> 0
        AND victim_descent IS NOT NULL AND victim_descent <> 'X'""",
    ("incidents",),
)
def filter_known(spark, sf):
    return (
        _incidents(spark, sf)
        .where(
            fc.is_known("victim_age", fc.UNKNOWN_AGE)
            & fc.is_known("victim_descent", fc.UNKNOWN_DESCENT)
        )
        .select("incident_id", "victim_age", "victim_descent")
    )


@_query(
    "SELECT incident_id, weapon_code FROM incidents WHERE weapon_code LIKE '1__'",
    ("incidents",),
)
def filter_like(spark, sf):
    return (
        _incidents(spark, sf)
        .where(fc.is_firearm("weapon_code"))
        .select("incident_id", "weapon_code")
    )


@_query(
    "SELECT incident_id, lat, lon FROM incidents WHERE lat <> 0 AND lon <> 0", ("incidents",)
)
def filter_location(spark, sf):
    return _incidents(spark, sf).where(fc.has_location()).select("incident_id", "lat", "lon")


# --- Joins -------------------------------------------------------------------

JOIN_ASSIGNED = """
SELECT i.incident_id, i.area_code, s.division
FROM incidents i JOIN stations s ON try_cast(i.area_code AS int) = s.prec"""


def _join_assigned(spark, sf, strategy=None):
    return reports.assigned_station(
        _incidents(spark, sf), _stations(spark, sf), strategy
    ).select("incident_id", "area_code", "division")


@_query(JOIN_ASSIGNED, STATION_VIEWS)
def join_assigned(spark, sf):
    return _join_assigned(spark, sf)


@_query(JOIN_ASSIGNED, STATION_VIEWS)
def join_hint_broadcast(spark, sf):
    return _join_assigned(spark, sf, "broadcast")


@_query(JOIN_ASSIGNED, STATION_VIEWS)
def join_hint_merge(spark, sf):
    return _join_assigned(spark, sf, "merge")


@_query(JOIN_ASSIGNED, STATION_VIEWS)
def join_hint_shuffle_hash(spark, sf):
    return _join_assigned(spark, sf, "shuffle_hash")


@_query(
    """SELECT i.incident_id, s.prec, s.division
    FROM busy_incidents i JOIN stations s ON try_cast(i.area_code AS int) = s.prec""",
    ("busy_incidents", "stations"),
)
def join_assigned_skewed(spark, sf):
    """A shuffle join on a key with two fifths of all rows."""
    return reports.assigned_station(
        load(spark, sf, "busy_incidents").select("incident_id", "area_code"),
        _stations(spark, sf),
        "split",
    ).select("incident_id", F.col("area").alias("prec"), "division")


@_query(
    f"""WITH {GEOZIP_SQL}, {INCOMES_SQL}
    SELECT g.lat, g.lon, g.zip, n.median_income FROM geozip g JOIN incomes n ON g.zip = n.zip""",
    ("geozip_raw", "incomes_raw"),
)
def join_zip_income(spark, sf):
    return (
        _geozip(spark, sf)
        .join(_incomes(spark, sf), "zip")
        .select("lat", "lon", "zip", "median_income")
    )


@_query(
    f"""WITH {GEOZIP_SQL}
    SELECT i.incident_id, g.zip FROM incidents i
    JOIN geozip g ON i.lat = g.lat AND i.lon = g.lon""",
    ("incidents", "geozip_raw"),
)
def join_point_zip(spark, sf):
    return (
        _incidents(spark, sf).join(_geozip(spark, sf), ["lat", "lon"]).select("incident_id", "zip")
    )


@_query(
    f"""WITH {GEOZIP_SQL}, {INCOMES_SQL},
      members AS (SELECT zip FROM incomes WHERE median_income >= 50000)
    SELECT g.lat, g.lon, g.zip FROM geozip g WHERE g.zip IN (SELECT zip FROM members)""",
    ("geozip_raw", "incomes_raw"),
)
def join_membership(spark, sf):
    members = _incomes(spark, sf).where(F.col("median_income") >= 50000)
    return selection.keep_members(_geozip(spark, sf), members, "zip").select("lat", "lon", "zip")


def nearest_depots_sql(places: str, depots: str, k: int = 1, more: str = "") -> str:
    return f"""
    WITH paired AS (SELECT p.place_id, d.depot_id, p.lat, p.lon, d.site_lat, d.site_lon
        FROM {places} p CROSS JOIN {depots} d),
      {geodesic_ctes("paired")},
      ranked AS (SELECT *, rank() OVER (PARTITION BY place_id ORDER BY distance_km) AS position
        FROM measured)
    SELECT place_id, depot_id, round(distance_km, 3) AS distance_km{more}
    FROM ranked WHERE position <= {k}"""


def _depot_distances(pairs: DataFrame, *more: str) -> DataFrame:
    return pairs.select(
        "place_id", "depot_id", F.round("distance_km", 3).alias("distance_km"), *more
    )


@_query(nearest_depots_sql("places", "depots"), ("places", "depots"))
def nearest_site(spark, sf):
    """Both sides grow with the data here; no side is assumed to be small."""
    return _depot_distances(
        nearest_sites_per_row(
            load(spark, sf, "places"), load(spark, sf, "depots"), key=["place_id"]
        )
    )


@_query(nearest_depots_sql("outposts", "crowded_depots"), ("outposts", "crowded_depots"))
def nearest_site_clustered(spark, sf):
    """Far points and crowded sites: any ring of cubes holds all sites or none."""
    return _depot_distances(
        nearest_sites(load(spark, sf, "outposts"), load(spark, sf, "crowded_depots"))
    )


@_query(
    nearest_depots_sql("places", "twin_depots", 3, ", cast(position AS int) AS position"),
    ("places", "twin_depots"),
)
def nearest_k_sites(spark, sf):
    """The three nearest depots, where depots come in pairs: four of ranks 1, 1, 3, 3."""
    found = nearest_sites(load(spark, sf, "places"), load(spark, sf, "twin_depots"), k=3)
    return _depot_distances(found, "position")


# --- Aggregates, order, sets -------------------------------------------------


@_query("SELECT premise, count(*) AS incidents FROM incidents GROUP BY premise", ("incidents",))
def count_by_key(spark, sf):
    return _incidents(spark, sf).groupBy("premise").agg(F.count("*").alias("incidents"))


@_query(
    """SELECT cast(year(date_occ) AS int) AS year, cast(month(date_occ) AS int) AS month,
      count(*) AS incidents FROM incidents GROUP BY 1, 2""",
    ("incidents",),
)
def count_by_year_month(spark, sf):
    return (
        _incidents(spark, sf)
        .groupBy(F.year("date_occ").alias("year"), F.month("date_occ").alias("month"))
        .agg(F.count("*").alias("incidents"))
    )


@_query(
    """SELECT area_code, round(avg(victim_age), 3) AS avg_age, count(*) AS incidents
      FROM incidents GROUP BY area_code""",
    ("incidents",),
)
def avg_count_by_key(spark, sf):
    return (
        _incidents(spark, sf)
        .groupBy("area_code")
        .agg(F.round(F.avg("victim_age"), 3).alias("avg_age"), F.count("*").alias("incidents"))
    )


ZIP_PAIRS = f"""WITH {GEOZIP_SQL}, {INCOMES_SQL},
  pairs AS (SELECT DISTINCT g.zip, n.median_income FROM geozip g JOIN incomes n ON g.zip = n.zip)
SELECT zip, median_income FROM pairs"""
ZIP_VIEWS = ("geozip_raw", "incomes_raw")


def _zip_pairs(spark, sf) -> DataFrame:
    return join_zip_income(spark, sf).select("zip", "median_income").distinct()


@_query(ZIP_PAIRS, ZIP_VIEWS)
def distinct_pairs(spark, sf):
    return _zip_pairs(spark, sf)


@_query(ZIP_PAIRS + " ORDER BY median_income DESC NULLS LAST, zip LIMIT 3", ZIP_VIEWS)
def top_n(spark, sf):
    return selection.top_n(_zip_pairs(spark, sf), "median_income", 3, ["zip"])


@_query(ZIP_PAIRS + " ORDER BY median_income ASC NULLS FIRST, zip LIMIT 3", ZIP_VIEWS)
def bottom_n(spark, sf):
    return selection.bottom_n(_zip_pairs(spark, sf), "median_income", 3, ["zip"])


@_query(
    f"""WITH segments AS (SELECT {SEGMENT_SQL} AS day_segment, count(*) AS incidents
      FROM incidents GROUP BY 1)
    SELECT day_segment, incidents,
      cast(row_number() OVER (ORDER BY incidents DESC, day_segment) AS int) AS position
    FROM segments""",
    ("incidents",),
)
def sorted_position(spark, sf):
    """The order of a sorted result as a column; there are five segments at most."""
    segments = (
        _incidents(spark, sf)
        .groupBy(fc.day_segment("time_occ").alias("day_segment"))
        .agg(F.count("*").alias("incidents"))
    )
    order = Window.orderBy(F.desc("incidents"), "day_segment")
    return segments.withColumn("position", F.row_number().over(order))


@_query(
    """SELECT incident_id, row_number() OVER (ORDER BY date_occ, incident_id) AS position,
      rank() OVER (ORDER BY date_occ DESC) AS newest FROM incidents""",
    ("incidents",),
)
def incident_positions(spark, sf):
    """Positions and ranks of all incidents, without a task that sees them all."""
    numbered = global_positions(
        _incidents(spark, sf).select("incident_id", "date_occ"), ["date_occ", "incident_id"]
    )
    return global_positions(
        numbered, ["date_occ"], descending=("date_occ",), ties="all", name="newest"
    ).select("incident_id", "position", "newest")


PARTIES = """SELECT c_nationkey AS nationkey, c_name AS name FROM customer
{union} SELECT s_nationkey AS nationkey, s_name AS name FROM supplier"""


@_query(PARTIES.format(union="UNION ALL"))
def union_all(spark, sf):
    customers = load(spark, sf, "customer").selectExpr("c_nationkey nationkey", "c_name name")
    suppliers = load(spark, sf, "supplier").selectExpr("s_name name", "s_nationkey nationkey")
    return customers.unionByName(suppliers)


@_query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, sf):
    customers = load(spark, sf, "customer").selectExpr("c_nationkey nationkey")
    suppliers = load(spark, sf, "supplier").selectExpr("s_nationkey nationkey")
    return customers.unionByName(suppliers).distinct()


# --- Scalar functions --------------------------------------------------------


@_query(
    "SELECT incident_id, cast(date_occ AS date) AS date_occ FROM incidents", ("incidents",)
)
def parse_date(spark, sf):
    text = _incidents(spark, sf).select("incident_id", _as_source_text("date_occ").alias("text"))
    return text.select("incident_id", fc.parse_date("text").alias("date_occ"))


@_query(
    """SELECT incident_id, cast(year(date_occ) AS int) AS year,
      cast(month(date_occ) AS int) AS month FROM incidents""",
    ("incidents",),
)
def date_parts(spark, sf):
    return spark.sql(
        """SELECT incident_id, EXTRACT(YEAR FROM date_occ) AS year,
          EXTRACT(MONTH FROM date_occ) AS month FROM {incidents}""",
        incidents=_incidents(spark, sf),
    )


@_query(f"WITH {INCOMES_SQL} SELECT zip, median_income FROM incomes", ("incomes_raw",))
def income_clean(spark, sf):
    return _incomes(spark, sf).select("zip", "median_income")


@_query(
    "SELECT zip_raw, split_part(zip_raw, '-', 1) AS zip FROM geozip_raw", ("geozip_raw",)
)
def zip_prefix(spark, sf):
    return load(spark, sf, "geozip_raw").select("zip_raw", fc.zip_prefix("zip_raw").alias("zip"))


@_query(
    f"SELECT incident_id, time_occ, {SEGMENT_SQL} AS day_segment FROM incidents",
    ("incidents",),
)
def day_segment_expr(spark, sf):
    return _incidents(spark, sf).select(
        "incident_id", "time_occ", fc.day_segment("time_occ").alias("day_segment")
    )


ASSIGNED_PAIRS = f"""
WITH assigned AS (SELECT i.incident_id, i.lat, i.lon, s.lat AS site_lat, s.lon AS site_lon
    FROM incidents i JOIN stations s ON try_cast(i.area_code AS int) = s.prec
    WHERE i.lat <> 0 AND i.lon <> 0),
  {{measured}}
SELECT incident_id, {{value}} FROM measured"""


def _assigned_distances(spark, sf, model):
    located = _incidents(spark, sf).where(fc.has_location())
    pairs = reports.assigned_station(located, _stations(spark, sf))
    return with_distance_km(pairs, "lat", "lon", "site_lat", "site_lon", model)


@_query(
    ASSIGNED_PAIRS.format(
        measured=geodesic_ctes("assigned"), value="round(distance_km, 3) AS distance_km"
    ),
    STATION_VIEWS,
)
def geodesic_distance(spark, sf):
    return _assigned_distances(spark, sf, "geodesic").select(
        "incident_id", F.round("distance_km", 3).alias("distance_km")
    )


@_query(
    ASSIGNED_PAIRS.format(
        measured=haversine_cte("assigned"), value="round(distance_km, 3) AS distance_km"
    ),
    STATION_VIEWS,
)
def haversine_distance(spark, sf):
    return _assigned_distances(spark, sf, "haversine").select(
        "incident_id", F.round("distance_km", 3).alias("distance_km")
    )


@_query(
    FIREARM_ASSIGNED.replace(
        MEAN, "concat(cast(round(avg(distance_km), 3) AS varchar), ' km') AS avg_distance"
    ),
    STATION_VIEWS,
)
def distance_label(spark, sf):
    report = reports.assigned_station_by_year(_incidents(spark, sf), _stations(spark, sf))
    return report.select("year", fc.km_label("avg_distance_km").alias("avg_distance"))

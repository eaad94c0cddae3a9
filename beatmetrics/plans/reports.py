"""The incident reports as DataFrame jobs.

No report shuffles raw incidents.  Where the other side of a join is small, rows
are joined and partially aggregated in the task that reads them, and only a few
sums cross the network.  Where rows have to meet by place – the nearest search,
and a large table of places – they are counted per place first, so that a busy
place is one row per task and not one large task; means are then weighted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatmetrics.functions.columns import (
    STREET,
    UNKNOWN_AGE,
    UNKNOWN_DESCENT,
    day_segment,
    has_location,
    in_year,
    is_firearm,
    is_known,
)
from beatmetrics.functions.distance import with_distance_km
from beatmetrics.functions.sums import exact_mean
from beatmetrics.operators.hints import with_strategy
from beatmetrics.operators.nearest import nearest_of_key, nearest_sites
from beatmetrics.operators.nearest import nearest_sites_per_row  # noqa: F401  for callers
from beatmetrics.operators.selection import bottom_n, keep_members, top_n, top_per_group
from beatmetrics.operators.skew import split_join


def top_periods(incidents: DataFrame, n: int = 3, ties: str = "all") -> DataFrame:
    """The ``n`` busiest months of each year."""
    months = incidents.groupBy(
        F.year("date_occ").alias("year"), F.month("date_occ").alias("month")
    ).agg(F.count("*").alias("incidents"))
    return top_per_group(
        months, ["year"], [F.desc("incidents")], n, ties, [F.asc("month")]
    ).orderBy("year", "position", "month")


def incidents_by_day_segment(incidents: DataFrame, premise: str = STREET) -> DataFrame:
    """Incidents at one kind of premise by part of the day, busiest first."""
    return (
        incidents.where(F.col("premise") == premise)
        .groupBy(day_segment("time_occ").alias("day_segment"))
        .agg(F.count("*").alias("incidents"))
        .orderBy(F.desc("incidents"), "day_segment")
    )


def known_victims(incidents: DataFrame, year: int) -> DataFrame:
    """Incidents of one year whose victim's age and descent are known."""
    return incidents.where(
        in_year("date_occ", year)
        & is_known("victim_age", UNKNOWN_AGE)
        & is_known("victim_descent", UNKNOWN_DESCENT)
    )


def victims_by_zip(
    incidents: DataFrame,
    geozip: DataFrame,
    incomes: DataFrame,
    year: int,
    strategy: str | None = None,
) -> DataFrame:
    """Known victims counted per ZIP code, its income and victim group.

    Victims are counted per place before the join, under every strategy, so
    that no place is hot; no job runs while the plan is built.
    """
    victims = (
        known_victims(incidents, year)
        .groupBy("lat", "lon", "victim_descent")
        .agg(F.count("*").alias("incidents"))
    )
    geozip = with_strategy(geozip, strategy)
    return (
        victims.join(geozip, ["lat", "lon"])
        .join(with_strategy(incomes, strategy), "zip")
        .groupBy("zip", "median_income", "victim_descent")
        .agg(F.sum("incidents").alias("incidents"))
        # Always true; it keeps the count in every use of this table, so that
        # all uses share one set of shuffles and the incidents are read once.
        .where(F.col("incidents") > 0)
    )


def income_extremes(
    by_zip: DataFrame, n: int = 3, distinct_zips: bool = True, nulls: str = "first"
) -> DataFrame:
    """The ZIP codes of the ``n`` highest and the ``n`` lowest incomes."""
    pairs = by_zip.select("zip", "median_income").distinct()
    chosen = (
        top_n(pairs, "median_income", n, ["zip"])
        .unionByName(bottom_n(pairs, "median_income", n, ["zip"], nulls))
        .select("zip")
    )
    return chosen.distinct() if distinct_zips else chosen


def victim_groups_by_income_extremes(
    incidents: DataFrame,
    geozip: DataFrame,
    incomes: DataFrame,
    year: int = 2015,
    n: int = 3,
    distinct_zips: bool = True,
    nulls: str = "first",
    strategy: str | None = None,
) -> DataFrame:
    """Victims by group in the richest and the poorest ZIP codes with victims.

    With ``distinct_zips=False`` a ZIP code on both lists counts twice.
    """
    by_zip = victims_by_zip(incidents, geozip, incomes, year, strategy)
    chosen = income_extremes(by_zip, n, distinct_zips, nulls)
    return (
        keep_members(by_zip, chosen, "zip", distinct_zips, strategy)
        .groupBy("victim_descent")
        .agg(F.sum("incidents").alias("incidents"))
        .orderBy(F.desc("incidents"), "victim_descent")
    )


def firearm_incidents(incidents: DataFrame) -> DataFrame:
    """Incidents with a firearm and a known location."""
    return incidents.where(is_firearm("weapon_code") & has_location())


def weapon_incidents(incidents: DataFrame) -> DataFrame:
    """Incidents with any weapon and a known location."""
    return incidents.where(F.col("weapon_code").isNotNull() & has_location())


def per_place(incidents: DataFrame, *groups: Column | str) -> DataFrame:
    """Incidents counted per place and group.

    The filter is always true.  It keeps the count in every use of the table;
    uses with different columns would each read the incidents again.
    """
    return (
        incidents.groupBy("lat", "lon", *groups)
        .agg(F.count("*").alias("incidents"))
        .where(F.col("incidents") > 0)
    )


def as_sites(stations: DataFrame, *columns: str) -> DataFrame:
    """Stations counted per place, under the names of the site columns."""
    return stations.groupBy(
        F.col("lat").alias("site_lat"), F.col("lon").alias("site_lon"), *columns
    ).agg(F.count("*").alias("site_count"))


def assigned_station(
    incidents: DataFrame, stations: DataFrame, strategy: str | None = None
) -> DataFrame:
    """Each row with the station whose precinct is the row's area.

    The area is text such as ``01``; text that is no number has no station.
    Besides the strategies of :mod:`~beatmetrics.operators.hints`, ``'split'``
    shuffles with frequent areas in parts, for station tables of any size.
    """
    sites = stations.select(
        F.col("prec").alias("area"),
        "division",
        F.col("lat").alias("site_lat"),
        F.col("lon").alias("site_lon"),
    )
    located = incidents.withColumn("area", F.col("area_code").try_cast("int"))
    if strategy == "split":
        return split_join(located, sites, ["area"])
    return located.join(with_strategy(sites, strategy), "area")


def mean_distance(pairs: DataFrame, group: str, weight: Column) -> DataFrame:
    """Mean distance and number of incidents per group.

    The mean is that of exact sums, so that the report is the same for any
    partitioning of the rows.
    """
    return pairs.groupBy(group).agg(
        F.round(exact_mean(F.col("distance_km"), weight), 3).alias("avg_distance_km"),
        F.sum(weight).alias("incidents"),
    )


def _assigned(located, stations, group, model, strategy) -> DataFrame:
    pairs = assigned_station(located, stations, strategy)
    pairs = with_distance_km(pairs, "lat", "lon", "site_lat", "site_lon", model)
    return mean_distance(pairs, group, F.lit(1))


def _nearest(located, sites, group, model) -> DataFrame:
    pairs = nearest_sites(located, sites, model)
    return mean_distance(pairs, group, F.col("incidents") * F.col("site_count"))


def _nearest_of_key(located, sites, model, key, *groups) -> DataFrame:
    """The nearest pairs of each key; rows that are equal in all that matters are one."""
    groups = [c for c in (*key, *groups) if c not in ("lat", "lon")]
    return nearest_of_key(per_place(located, *dict.fromkeys(groups)), sites, key, model)


def assigned_station_by_year(
    incidents: DataFrame,
    stations: DataFrame,
    model: str = "geodesic",
    strategy: str | None = None,
) -> DataFrame:
    """Firearm incidents per year and their mean distance to the station in charge."""
    located = firearm_incidents(incidents).select(
        "lat", "lon", "area_code", F.year("date_occ").alias("year")
    )
    return _assigned(located, stations, "year", model, strategy).orderBy("year")


def nearest_station_by_year(
    incidents: DataFrame,
    stations: DataFrame,
    model: str = "geodesic",
    key: list[str] | None = None,
) -> DataFrame:
    """Firearm incidents per year and their mean distance to the nearest station.

    An incident with several equally near stations counts once for each.  A row
    is an incident; where numbers repeat with different places, name their
    column as ``key`` and only the nearest row of a number counts.
    """
    firearms = firearm_incidents(incidents).withColumn("year", F.year("date_occ"))
    sites = as_sites(stations)
    if key is None:
        nearest = _nearest(per_place(firearms, "year"), sites, "year", model)
    else:
        pairs = _nearest_of_key(firearms, sites, model, key, "year")
        nearest = mean_distance(pairs, "year", F.col("incidents") * F.col("site_count"))
    return nearest.orderBy("year")


def assigned_station_report(
    incidents: DataFrame,
    stations: DataFrame,
    model: str = "geodesic",
    strategy: str | None = None,
) -> DataFrame:
    """Weapon incidents per division in charge and their mean distance to it."""
    located = weapon_incidents(incidents).select("lat", "lon", "area_code")
    return _assigned(located, stations, "division", model, strategy).orderBy(
        F.desc("incidents"), "division"
    )


def nearest_station_report(
    incidents: DataFrame,
    stations: DataFrame,
    model: str = "geodesic",
    key: list[str] | None = None,
) -> DataFrame:
    """Weapon incidents per nearest division and their mean distance to it.

    Ties and ``key`` as in :func:`nearest_station_by_year`.
    """
    weapons = weapon_incidents(incidents)
    sites = as_sites(stations, "division")
    if key is None:
        nearest = _nearest(per_place(weapons), sites, "division", model)
    else:
        pairs = _nearest_of_key(weapons, sites, model, key)
        nearest = mean_distance(pairs, "division", F.col("incidents") * F.col("site_count"))
    return nearest.orderBy(F.desc("incidents"), "division")


def profile(df: DataFrame) -> DataFrame:
    """One row per column: its type, the number of rows and of nulls.

    One pass over the data with partial counts; only one row is unfolded.
    """
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col("rows"),
                (F.col("rows") - F.col(f"c{i}")).alias("nulls"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return counts.select(F.inline(lines))

"""The reports on hand-made frames: ties, nulls, duplicates and other edges."""

import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from beatmetrics.functions.distance import vincenty_km
from beatmetrics.operators.selection import bottom_n
from beatmetrics.plans import reports, sql_reports

INCIDENT = (
    "incident_id string, date_occ date, time_occ string, area_code string, premise string, "
    "weapon_code string, victim_age int, victim_descent string, lat double, lon double"
)
DEFAULTS = {
    "date_occ": datetime.date(2015, 6, 1),
    "time_occ": "1200",
    "area_code": "01",
    "premise": "STREET",
    "weapon_code": "101",
    "victim_age": 30,
    "victim_descent": "W",
    "lat": 34.0,
    "lon": -118.0,
}


def incidents(spark, *rows):
    names = [f.split()[0] for f in INCIDENT.split(", ")]
    full = [{"incident_id": str(i), **DEFAULTS, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], INCIDENT)


def stations(spark, *rows):
    return spark.createDataFrame(list(rows), "prec int, division string, lat double, lon double")


def geozip(spark, *rows):
    return spark.createDataFrame(list(rows), "lat double, lon double, zip string")


def incomes(spark, *rows):
    return spark.createDataFrame(list(rows), "zip string, median_income int")


def rows(df):
    return [tuple(r) for r in df.collect()]


def month(m, year=2015, **values):
    return {"date_occ": datetime.date(year, m, 3), **values}


def test_top_periods_keeps_or_breaks_ties(spark):
    df = incidents(spark, *[month(m) for m in (1, 1, 1, 2, 2, 3, 3, 4, 4, 5)])
    expected = [(2015, 1, 3, 1), (2015, 2, 2, 2), (2015, 3, 2, 2), (2015, 4, 2, 2)]
    assert rows(reports.top_periods(df)) == expected
    assert rows(sql_reports.top_periods(spark, df)) == expected
    first = rows(reports.top_periods(df, ties="first"))
    assert first == [(2015, 1, 3, 1), (2015, 2, 2, 2), (2015, 3, 2, 3)]
    with pytest.raises(ValueError):
        reports.top_periods(df, ties="some")


def test_top_periods_of_several_years_and_null_dates(spark):
    df = incidents(spark, month(1), month(2, 2016), month(2, 2016), {"date_occ": None})
    assert rows(reports.top_periods(df, n=1)) == [
        (None, None, 1, 1),
        (2015, 1, 1, 1),
        (2016, 2, 2, 1),
    ]


def test_day_segments(spark):
    times = ["0459", "0500", "1159", "1200", "1659", "1700", "2059", "2100", "", None]
    df = incidents(
        spark,
        *[{"time_occ": t} for t in times],
        {"premise": "SIDEWALK"},
        {"premise": None},
    )
    expected = {"NIGHT": 2, "MORNING": 2, "AFTERNOON": 2, "EVENING": 2, "UNKNOWN": 2}
    report = reports.incidents_by_day_segment(df)
    assert dict(rows(report)) == expected
    assert rows(report) == rows(sql_reports.incidents_by_day_segment(spark, df))
    assert sum(n for _, n in rows(report)) == df.where("premise = 'STREET'").count()


def place(i):
    return {"lat": 34.0 + i, "lon": -118.0}


def income_world(spark, zips):
    """Place i has the ZIP 9000i."""
    geo = geozip(spark, *[(34.0 + i, -118.0, f"9000{i}") for i in range(zips)])
    money = incomes(spark, *[(f"9000{i}", 1000 * (i + 1)) for i in range(zips)])
    return geo, money


def test_victims_of_the_extreme_zips(spark):
    geo, money = income_world(spark, 8)
    df = incidents(
        spark,
        *[{**place(i), "victim_descent": "ABCDEFGH"[i]} for i in range(8)],
        {**place(0), "victim_age": 0},
        {**place(0), "victim_age": None},
        {**place(0), "victim_descent": "X"},
        {**place(0), "victim_descent": None},
        {**place(0), "date_occ": datetime.date(2016, 1, 1)},
        {**place(0), "date_occ": datetime.date(2014, 12, 31)},
        {"lat": 1.0, "lon": 1.0},
    )
    report = reports.victim_groups_by_income_extremes(df, geo, money)
    assert rows(report) == [(d, 1) for d in "ABCFGH"]
    twin = sql_reports.victim_groups_by_income_extremes(spark, df, geo, money)
    assert rows(twin) == rows(report)


def test_zip_on_both_lists_counts_twice_only_on_request(spark):
    geo, money = income_world(spark, 4)
    df = incidents(spark, *[{**place(i), "victim_descent": "ABCD"[i]} for i in range(4)])
    once = reports.victim_groups_by_income_extremes(df, geo, money)
    assert dict(rows(once)) == dict.fromkeys("ABCD", 1)
    twice = reports.victim_groups_by_income_extremes(df, geo, money, distinct_zips=False)
    assert dict(rows(twice)) == {"A": 1, "B": 2, "C": 2, "D": 1}


def test_only_zips_with_victims_are_ranked(spark):
    geo, money = income_world(spark, 8)
    df = incidents(spark, *[{**place(i), "victim_descent": "ABCDEFGH"[i]} for i in (3, 4)])
    report = reports.victim_groups_by_income_extremes(df, geo, money, n=1)
    assert dict(rows(report)) == {"D": 1, "E": 1}


def test_duplicate_places_and_zips_multiply_rows(spark):
    df = incidents(spark, place(0), place(0))
    geo = geozip(spark, (34.0, -118.0, "90000"), (34.0, -118.0, "90000"))
    money = incomes(spark, ("90000", 1000), ("90000", 2000))
    report = reports.victim_groups_by_income_extremes(df, geo, money)
    assert rows(report) == [("W", 8)]
    assert rows(sql_reports.victim_groups_by_income_extremes(spark, df, geo, money)) == [("W", 8)]


def test_shuffled_table_of_places(spark):
    """A shuffled join by place gives the same result as the join of Spark's choice."""
    geo, money = income_world(spark, 8)
    hot = [{**place(0), "victim_descent": "H"}] * 40
    df = incidents(spark, *hot, *[{**place(i), "victim_descent": "ABCDEFGH"[i]} for i in range(8)])
    small = rows(reports.victim_groups_by_income_extremes(df, geo, money))
    large = reports.victim_groups_by_income_extremes(df, geo, money, strategy="merge")
    assert rows(large) == small
    assert dict(small)["H"] == 41


def test_null_income_sorts_first_or_is_dropped(spark):
    geo, _ = income_world(spark, 3)
    money = incomes(spark, ("90000", None), ("90001", 10), ("90002", 20))
    df = incidents(spark, *[{**place(i), "victim_descent": "ABC"[i]} for i in range(3)])
    first = reports.victim_groups_by_income_extremes(df, geo, money, n=1)
    assert dict(rows(first)) == {"A": 1, "C": 1}
    dropped = reports.victim_groups_by_income_extremes(df, geo, money, n=1, nulls="drop")
    assert dict(rows(dropped)) == {"B": 1, "C": 1}
    with pytest.raises(ValueError):
        bottom_n(money, "median_income", 1, ["zip"], nulls="last")


def test_equal_incomes_are_ordered_by_zip(spark):
    geo, _ = income_world(spark, 5)
    money = incomes(spark, *[(f"9000{i}", 7) for i in range(5)])
    df = incidents(spark, *[{**place(i), "victim_descent": "ABCDE"[i]} for i in range(5)])
    assert dict(rows(reports.victim_groups_by_income_extremes(df, geo, money, n=2))) == {
        "A": 1,
        "B": 1,
    }


STATIONS = [(1, "Central", 34.1, -118.0), (2, "Harbor", 33.8, -118.0), (3, "West", 34.0, -118.3)]


def expected_mean(pairs):
    return round(sum(float(vincenty_km(*p)) for p in pairs) / len(pairs), 3)


def test_assigned_station(spark):
    df = incidents(
        spark,
        {"area_code": "01"},
        {"area_code": "1", "lat": 34.05},
        {"area_code": "02", "weapon_code": "400"},
        {"area_code": "x1"},
        {"area_code": None},
        {"area_code": "99"},
        {"weapon_code": "10"},
        {"weapon_code": "1010"},
        {"weapon_code": None},
        {"lat": 0.0},
        {"lon": 0.0},
        {"lat": None},
    )
    sites = stations(spark, *STATIONS)
    central = [(34.0, -118.0, 34.1, -118.0), (34.05, -118.0, 34.1, -118.0)]
    by_year = reports.assigned_station_by_year(df, sites)
    assert rows(by_year) == [(2015, expected_mean(central), 2)]
    assert rows(sql_reports.assigned_station_by_year(spark, df, sites)) == rows(by_year)
    by_division = reports.assigned_station_report(df, sites)
    three = central + [(34.0, -118.0, 34.1, -118.0)] * 2
    harbor = [(34.0, -118.0, 33.8, -118.0)]
    assert rows(by_division) == [
        ("Central", expected_mean(three), 4),
        ("Harbor", expected_mean(harbor), 1),
    ]
    assert rows(sql_reports.assigned_station_report(spark, df, sites)) == rows(by_division)


@pytest.mark.parametrize("strategy", [None, "broadcast", "merge", "shuffle_hash"])
def test_strategies_do_not_change_the_result(spark, strategy):
    df = incidents(spark, {}, {"area_code": "02"}, {"area_code": "03", "lat": 34.2})
    sites = stations(spark, *STATIONS)
    plain = rows(reports.assigned_station_report(df, sites))
    assert rows(reports.assigned_station_report(df, sites, strategy=strategy)) == plain
    geo, money = income_world(spark, 2)
    plain = rows(reports.victim_groups_by_income_extremes(df, geo, money))
    assert (
        rows(reports.victim_groups_by_income_extremes(df, geo, money, strategy=strategy)) == plain
    )


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        reports.assigned_station_report(incidents(spark, {}), stations(spark, *STATIONS), strategy="x")


@pytest.mark.parametrize("model", ["geodesic", "haversine"])
def test_nearest_station_ties_count_for_each(spark, model):
    """Two stations at one place: the incident counts for both."""
    sites = stations(spark, (1, "A", 34.1, -118.0), (2, "B", 34.1, -118.0), (3, "C", 35.0, -118.0))
    df = incidents(spark, {}, {"lat": 35.0})
    by_division = reports.nearest_station_report(df, sites, model)
    assert [(d, n) for d, _, n in rows(by_division)] == [("A", 1), ("B", 1), ("C", 1)]
    ((year, _, n),) = rows(reports.nearest_station_by_year(df, sites, model))
    assert (year, n) == (2015, 3)


def test_nearest_equals_per_row_search(spark):
    """Counts per place give what a rank per incident gives."""
    df = incidents(
        spark,
        *[{"lat": 34.0 + (i % 5) / 50, "date_occ": datetime.date(2015 + i % 3, 1, 1)} for i in range(60)],
    )
    sites = stations(spark, *STATIONS)
    for report in (reports.nearest_station_by_year, reports.nearest_station_report):
        assert rows(report(df, sites)) == rows(report(df, sites, key=["incident_id"]))
    assert rows(sql_reports.nearest_station_by_year(spark, df, sites)) == rows(
        reports.nearest_station_by_year(df, sites)
    )
    assert rows(sql_reports.nearest_station_report(spark, df, sites)) == rows(
        reports.nearest_station_report(df, sites)
    )


def test_nearest_is_never_farther_than_assigned(spark, sf_dir):
    from beatmetrics.sources.derived import load

    df, sites = load(spark, sf_dir, "incidents"), load(spark, sf_dir, "stations")
    located = reports.weapon_incidents(df)
    nearest = reports.nearest_sites_per_row(
        located.select("incident_id", "lat", "lon"), reports.as_sites(sites), ties="first"
    ).select("incident_id", F.col("distance_km").alias("nearest_km"))
    assigned = reports.with_distance_km(
        reports.assigned_station(located, sites), "lat", "lon", "site_lat", "site_lon"
    )
    both = assigned.join(nearest, "incident_id")
    assert both.count() == located.count()
    assert both.where("nearest_km > distance_km + 1e-9").count() == 0


def test_a_busy_place_weighs_like_its_rows(spark):
    """A third of all incidents at one place; the mean is over rows, not places."""
    df = incidents(spark, *[{}] * 50, *[{"lat": 34.0 + i / 100} for i in range(1, 101)])
    sites = stations(spark, *STATIONS)
    ((_, mean, n),) = rows(reports.assigned_station_by_year(df, sites))
    pairs = [(34.0, -118.0, 34.1, -118.0)] * 50
    pairs += [(34.0 + i / 100, -118.0, 34.1, -118.0) for i in range(1, 101)]
    assert (mean, n) == (expected_mean(pairs), 150)


def test_mean_without_any_distance_is_null(spark):
    df = incidents(spark, {})
    sites = stations(spark, (1, "Central", None, None))
    assert rows(reports.assigned_station_report(df, sites)) == [("Central", None, 1)]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "`a b` int, c string")
    assert rows(reports.profile(df)) == [("a b", "int", 3, 1), ("c", "string", 3, 2)]
    assert Counter(r[2] for r in rows(reports.profile(df.limit(0)))) == {0: 2}


def test_views_for_own_sql(spark):
    from beatmetrics.functions.distance import register_functions

    register_functions(spark)
    sql_reports.register_views(
        test_incidents=incidents(spark, {}), test_stations=stations(spark, *STATIONS)
    )
    row = spark.sql(
        """SELECT i.lat AS from_lat, s.lat AS to_lat, s.lon AS to_lon,
             geodesic_km(from_lat, i.lon, to_lat, to_lon) AS km
           FROM test_incidents i JOIN test_stations s ON try_cast(i.area_code AS INT) = s.prec"""
    ).first()
    assert row.km == pytest.approx(float(vincenty_km(34.0, -118.0, 34.1, -118.0)))

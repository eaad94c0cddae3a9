"""The physical plans: join nodes, push-down, shared shuffles, no Python where none is needed."""

import re

import pytest

from beatmetrics.catalog import QUERIES
from beatmetrics.operators import hints
from beatmetrics.plans import reports, sql_reports
from beatmetrics.sources.derived import load


@pytest.fixture(scope="module")
def data(spark, sf_dir, tmp_path_factory):
    """The derived tables as parquet files of their own."""
    root = tmp_path_factory.mktemp("tables")
    frames = {}
    for name in ("incidents", "stations", "geozip_raw", "incomes_raw"):
        frame = load(spark, sf_dir, name)
        if name == "incidents":
            frame = frame.withColumn("date_occ", frame.date_occ.cast("date"))
        frame.write.parquet(f"{root}/{name}.parquet")
        frames[name] = spark.read.parquet(f"{root}/{name}.parquet")
    frames["geozip"] = frames["geozip_raw"].selectExpr("lat", "lon", "split_part(zip_raw, '-', 1) zip")
    frames["incomes"] = frames["incomes_raw"].selectExpr(
        "zip", "try_cast(translate(income_raw, '$,', '') AS int) median_income"
    )
    return frames


def plan(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if run else text


def extremes(data, **options):
    return reports.victim_groups_by_income_extremes(
        data["incidents"], data["geozip"], data["incomes"], 1999, **options
    )


@pytest.mark.parametrize(
    "strategy, node",
    [
        ("broadcast", "BroadcastHashJoin"),
        ("merge", "SortMergeJoin"),
        ("shuffle_hash", "ShuffledHashJoin"),
    ],
)
def test_hint_gives_join(data, strategy, node):
    df = reports.assigned_station(data["incidents"], data["stations"], strategy)
    assert node in plan(df)


def test_large_side_is_not_broadcast_on_request(spark, data):
    big = data["incidents"].select("incident_id")
    with pytest.warns(UserWarning):
        hinted = hints.with_strategy(big, "broadcast", max_bytes=100)
    text = big.join(hinted, "incident_id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in text.lower()


def test_no_python_in_the_first_three_reports(data):
    for df in (
        reports.top_periods(data["incidents"]),
        reports.incidents_by_day_segment(data["incidents"]),
        extremes(data),
    ):
        assert "EvalPython" not in plan(df)


def test_filters_and_columns_reach_the_scan(data):
    text = plan(reports.known_victims(data["incidents"], 1999).select("lat", "lon"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(date_occ,1999-01-01\)", text)
    assert "LessThan(date_occ,2000-01-01)" in text
    assert "premise" not in text and "incident_id" not in text
    text = plan(reports.incidents_by_day_segment(data["incidents"]))
    assert "EqualTo(premise,STREET)" in text
    assert "ReadSchema: struct<time_occ:string,premise:string>" in text
    text = plan(reports.firearm_incidents(data["incidents"]))
    assert "StringStartsWith(weapon_code,1)" in text or "IsNotNull(weapon_code)" in text


def scans(text, column):
    return [line for line in text.splitlines() if "FileScan" in line and column in line]


@pytest.mark.parametrize("report", ["nearest_station_by_year", "nearest_station_report"])
@pytest.mark.parametrize("module", [reports, sql_reports])
def test_nearest_reads_the_incidents_once(spark, data, report, module):
    args = (data["incidents"], data["stations"])
    if module is sql_reports:
        args = (spark, *args)
    text = plan(getattr(module, report)(*args), run=True)
    assert len(scans(text, "weapon_code")) == 1
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("report", ["nearest_station_by_year", "nearest_station_report"])
def test_nearest_of_a_key_measures_once(data, report):
    """No self-join: one pass of the distance, the key cut before its shuffle."""
    df = getattr(reports, report)(data["incidents"], data["stations"], key=["incident_id"])
    text = plan(df, run=True)
    assert len(scans(text, "weapon_code")) <= 2
    assert text.count("ArrowEvalPython") == 1
    cut = [line for line in text.splitlines() if "WindowGroupLimit [incident_id" in line]
    assert [kind for line in cut for kind in ("Partial", "Final") if kind in line] == ["Final", "Partial"]


@pytest.mark.parametrize("statement", [sql_reports.FIREARM_NEAREST, sql_reports.WEAPON_NEAREST])
def test_nearest_in_sql_is_one_statement(spark, data, statement):
    tables = {"incidents": data["incidents"], "stations": data["stations"]}
    sql_reports.register_functions(spark)
    text = plan(spark.sql(statement, **tables), run=True)
    assert "CROSS" not in statement.upper() and "NestedLoop" not in text and "Cartesian" not in text


def test_victims_are_counted_per_place_before_any_shuffle(spark, data):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (
            extremes(data),
            sql_reports.victim_groups_by_income_extremes(
                spark, data["incidents"], data["geozip"], data["incomes"], 1999
            ),
        ):
            lines = plan(df).splitlines()
            at = next(i for i, line in enumerate(lines) if "FileScan" in line and "victim_age" in line)
            above = next(i for i in range(at, 0, -1) if " Exchange " in lines[i])
            partial = [line for line in lines[above:at] if "HashAggregate" in line]
            assert len(partial) == 1 and "partial_count" in partial[0]
            assert all(c in partial[0].split("functions")[0] for c in ("lat", "lon", "descent"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_extremes_read_the_incidents_once(spark, data):
    text = plan(extremes(data), run=True)
    assert len(scans(text, "victim_descent")) == 1
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "TakeOrderedAndProject" in text
    text = plan(
        sql_reports.victim_groups_by_income_extremes(
            spark, data["incidents"], data["geozip"], data["incomes"], 1999
        ),
        run=True,
    )
    assert len(scans(text, "victim_descent")) == 1


@pytest.mark.parametrize("report", ["assigned_station_by_year", "assigned_station_report"])
def test_assigned_shuffles_only_sums(data, report):
    text = plan(getattr(reports, report)(data["incidents"], data["stations"]))
    assert "BroadcastHashJoin" in text
    below = text.split("HashAggregate")[-1]
    assert "partial_sum" in below and "hashpartitioning" not in below


def test_rank_filter_becomes_a_group_limit(data):
    assert "WindowGroupLimit" in plan(reports.top_periods(data["incidents"]))


def test_no_registered_query_has_a_cross_join(spark, sf_dir):
    for name, build in QUERIES.items():
        text = plan(build(spark, sf_dir))
        assert "NestedLoop" not in text and "Cartesian" not in text, name

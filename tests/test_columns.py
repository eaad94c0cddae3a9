import datetime

import pytest
from pyspark.sql import functions as F

from beatmetrics.functions import columns as fc


def values(spark, inputs, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(build("v")).collect()]


def test_parse_date_gives_null_for_bad_text(spark):
    texts = ["01/08/2020 12:00:00 AM", "12/31/2019 11:59:00 PM", "2020-01-08", "", None]
    assert values(spark, texts, fc.parse_date) == [
        datetime.date(2020, 1, 8),
        datetime.date(2019, 12, 31),
        None,
        None,
        None,
    ]


def test_parse_money(spark):
    texts = ["$12,345", "$1,234,567", "99", "", "n/a", None]
    assert values(spark, texts, fc.parse_money) == [12345, 1234567, 99, None, None, None]


def test_zip_prefix(spark):
    texts = ["90001-1234", "90002", "90003-", "", None]
    assert values(spark, texts, fc.zip_prefix) == ["90001", "90002", "90003", "", None]


@pytest.mark.parametrize(
    "text, segment",
    [
        ("0459", "NIGHT"),
        ("0500", "MORNING"),
        ("1159", "MORNING"),
        ("1200", "AFTERNOON"),
        ("1659", "AFTERNOON"),
        ("1700", "EVENING"),
        ("2059", "EVENING"),
        ("2100", "NIGHT"),
        ("0000", "NIGHT"),
        ("", "UNKNOWN"),
        ("xx12", "UNKNOWN"),
        (None, "UNKNOWN"),
    ],
)
def test_day_segment_as_column_and_in_sql(spark, text, segment):
    from beatmetrics.functions.distance import register_functions

    register_functions(spark)
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(fc.day_segment("v")).first()[0] == segment
    assert spark.sql("SELECT day_segment(v) FROM {df}", df=df).first()[0] == segment


def test_firearm_needs_three_characters(spark):
    codes = ["10", "101", "199", "1010", "400", "", None]
    kept = [bool(v) for v in values(spark, codes, fc.is_firearm)]
    assert kept == [False, True, True, False, False, False, False]


def test_location_needs_both_coordinates(spark):
    points = [(34.0, -118.0), (0.0, -118.0), (34.0, 0.0), (None, -118.0), (34.0, None)]
    df = spark.createDataFrame(points, "lat double, lon double")
    assert df.where(fc.has_location()).count() == 1


def test_known_values(spark):
    df = spark.createDataFrame([(0, "W"), (30, "X"), (30, None), (None, "W"), (30, "W")], "a int, d string")
    kept = df.where(fc.is_known("a", fc.UNKNOWN_AGE) & fc.is_known("d", fc.UNKNOWN_DESCENT))
    assert [tuple(r) for r in kept.collect()] == [(30, "W")]


def test_in_year_has_both_ends(spark):
    days = ["2014-12-31", "2015-01-01", "2015-12-31", "2016-01-01", None]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    kept = df.select(F.col("d").cast("date").alias("d")).where(fc.in_year("d", 2015))
    assert sorted(str(r.d) for r in kept.collect()) == ["2015-01-01", "2015-12-31"]


def test_km_label_keeps_the_shortest_text(spark):
    km = [2.5, 0.12349, 3.0, None]
    assert values(spark, km, fc.km_label, "double") == ["2.5 km", "0.123 km", "3.0 km", None]

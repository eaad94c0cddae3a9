"""CSV sources: header row, explicit schema, no inference pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beatmetrics.functions.columns import parse_date, parse_money, zip_prefix
from beatmetrics.sources import schemas


def _read(spark: SparkSession, paths: str | list[str], schema, **options) -> DataFrame:
    # A quote inside a quoted field is doubled, as RFC 4180 has it.
    return spark.read.csv(paths, schema=schema, header=True, **{"escape": '"', **options})


def read_incidents(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """Incidents of one or several files as one table, with both dates parsed."""
    return _read(spark, paths, schemas.INCIDENTS, **options).withColumns(
        {name: parse_date(name) for name in ("date_reported", "date_occ")}
    )


def read_incomes(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """Median income per ZIP code, as an int."""
    return _read(spark, paths, schemas.INCOMES, **options).withColumn(
        "median_income", parse_money("median_income")
    )


def read_geozip(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """ZIP code per coordinate, cut to five digits."""
    return _read(spark, paths, schemas.GEOZIP, **options).withColumn("zip", zip_prefix("zip"))


def read_stations(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """Police stations."""
    return _read(spark, paths, schemas.STATIONS, **options)

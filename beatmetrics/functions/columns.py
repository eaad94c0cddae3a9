"""Scalar expressions; all of them stay inside whole-stage code generation."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats, sentinels and hour limits of the incident data.
DATE_PATTERN = "MM/dd/yyyy hh:mm:ss a"
UNKNOWN_AGE = 0
UNKNOWN_DESCENT = "X"
FIREARM_PATTERN = "1__"
STREET = "STREET"
MORNING_HOURS = (5, 12)
AFTERNOON_HOURS = (12, 17)
EVENING_HOURS = (17, 21)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(text: Column | str, pattern: str = DATE_PATTERN) -> Column:
    """Date of a text timestamp; null where the text does not fit the pattern."""
    return F.try_to_date(_col(text), pattern)


def parse_money(text: Column | str) -> Column:
    """``$12,345`` as the int 12345; null where no number is left."""
    return F.translate(_col(text), "$,", "").try_cast("int")


def zip_prefix(text: Column | str) -> Column:
    """The five-digit part of a ZIP or ZIP+4 code."""
    return F.substring_index(_col(text), "-", 1)


def day_segment(time_text: Column | str) -> Column:
    """Part of the day of an ``HHmm`` text; UNKNOWN where no hour can be read.

    The null hour is tested first: it would fall through to NIGHT otherwise.
    """
    hour = F.substring(_col(time_text), 1, 2).try_cast("int")

    def within(hours: tuple[int, int]) -> Column:
        return (hour >= hours[0]) & (hour < hours[1])

    return (
        F.when(hour.isNull(), "UNKNOWN")
        .when(within(MORNING_HOURS), "MORNING")
        .when(within(AFTERNOON_HOURS), "AFTERNOON")
        .when(within(EVENING_HOURS), "EVENING")
        .otherwise("NIGHT")
    )


def in_year(date: Column | str, year: int) -> Column:
    """Rows of one calendar year, as a range that file sources can push down."""
    date = _col(date)
    return (date >= F.lit(datetime.date(year, 1, 1))) & (
        date < F.lit(datetime.date(year + 1, 1, 1))
    )


def is_known(value: Column | str, unknown: object) -> Column:
    """Neither null nor the value that stands for "unknown"."""
    value = _col(value)
    return value.isNotNull() & (value != F.lit(unknown))


def has_location(lat: Column | str = "lat", lon: Column | str = "lon") -> Column:
    """Both coordinates are set; zero stands for an unknown location."""
    return (_col(lat) != 0) & (_col(lon) != 0)


def is_firearm(weapon_code: Column | str) -> Column:
    return _col(weapon_code).like(FIREARM_PATTERN)


def km_label(km: Column | str, digits: int = 3) -> Column:
    """``2.5 km``: the rounded distance as text."""
    return F.concat(F.round(_col(km), digits).cast("string"), F.lit(" km"))

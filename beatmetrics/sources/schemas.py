"""Schemas of the four CSV inputs.

The readers bind columns by position, so the names are ours; the order and
the types are fixed by the files.
"""

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType


def _schema(names: str, **types) -> StructType:
    return StructType(
        [StructField(name, types.get(name, StringType())) for name in names.split()]
    )


# Column order and types of the input files.
INCIDENTS = _schema(
    """
    incident_id date_reported date_occ time_occ area_code area_name report_district
    part crime_code crime_desc mocodes victim_age victim_sex victim_descent
    premise_code premise weapon_code weapon status status_desc
    crime_code_1 crime_code_2 crime_code_3 crime_code_4 address cross_street lat lon
    """,
    victim_age=IntegerType(),
    lat=DoubleType(),
    lon=DoubleType(),
)
INCOMES = _schema("zip community median_income")
GEOZIP = _schema("lat lon zip", lat=DoubleType(), lon=DoubleType())
STATIONS = _schema(
    "lon lat fid division address prec",
    lon=DoubleType(),
    lat=DoubleType(),
    fid=IntegerType(),
    prec=IntegerType(),
)

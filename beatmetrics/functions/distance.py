"""Distance in km between two points given in degrees."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Mean Earth radius, and the WGS-84 ellipsoid.
EARTH_RADIUS_KM = 6371.0088
WGS84_MAJOR_KM = 6378.137
WGS84_FLATTENING = 1 / 298.257223563

# The WGS-84 radii of curvature span 6335.4 to 6399.6 km, so a haversine
# distance is within 0.6 % of the geodesic one.
HAVERSINE_ERROR = 0.006

MODELS = ("geodesic", "haversine")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on the sphere, from built-in columns."""
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * half_dlon * half_dlon
    # Rounding may lift opposite points above 1; least() would also lift a null.
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def _solver():
    """The geodesic solver as a local function.

    Local functions travel to the executors by value, so the workers need NumPy
    and pandas but not this package.
    """
    a, f = WGS84_MAJOR_KM, WGS84_FLATTENING
    b = a * (1 - f)

    def reduced(lat):
        u = np.arctan((1 - f) * np.tan(np.radians(lat)))
        return np.sin(u), np.cos(u)

    def longitude(omega, sigma, sin_alpha, cos2_alpha, cos_2m):
        """Longitude difference on the ellipsoid for one on the auxiliary sphere."""
        c = f / 16 * cos2_alpha * (4 + f * (4 - 3 * cos2_alpha))
        turn = cos_2m + c * np.cos(sigma) * (2 * cos_2m**2 - 1)
        return omega - (1 - c) * f * sin_alpha * (sigma + c * np.sin(sigma) * turn)

    def length(sigma, cos2_alpha, cos_2m):
        u_sq = cos2_alpha * (a**2 - b**2) / b**2
        big_a = 1 + u_sq / 16384 * (4096 + u_sq * (u_sq * (320 - 175 * u_sq) - 768))
        big_b = u_sq / 1024 * (256 + u_sq * (u_sq * (74 - 47 * u_sq) - 128))
        sin_s, cos_s = np.sin(sigma), np.cos(sigma)
        third = big_b / 6 * cos_2m * (4 * sin_s**2 - 3) * (4 * cos_2m**2 - 3)
        second = big_b / 4 * (cos_s * (2 * cos_2m**2 - 1) - third)
        return b * big_a * (sigma - big_b * sin_s * (cos_2m + second))

    def by_iteration(lat1, lat2, span, steps):
        su1, cu1 = reduced(lat1)
        su2, cu2 = reduced(lat2)

        def arc(lam):
            sl, cl = np.sin(lam), np.cos(lam)
            sin_s = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            cos_s = su1 * su2 + cu1 * cu2 * cl
            sin_alpha = np.where(sin_s == 0, 0.0, cu1 * cu2 * sl / sin_s)
            cos2_alpha = 1 - sin_alpha**2
            # Along the equator cos2_alpha is 0 and the term drops out.
            cos_2m = np.where(cos2_alpha < 1e-15, 0.0, cos_s - 2 * su1 * su2 / cos2_alpha)
            return np.arctan2(sin_s, cos_s), sin_alpha, cos2_alpha, cos_2m

        lam = span
        settled = np.zeros(span.shape, dtype=bool)
        for _ in range(steps):
            following = span + lam - longitude(lam, *arc(lam))
            # A settled row stays as it is, however long its batch goes on, so
            # that equal pairs get equal distances in every batch.
            settled_now = (np.abs(following - lam) < 1e-12) & (np.abs(following) <= np.pi)
            lam = np.where(settled, lam, following)
            settled |= settled_now
            if (settled | np.isnan(following)).all():
                break
        sigma, _, cos2_alpha, cos_2m = arc(lam)
        return np.where(settled, length(sigma, cos2_alpha, cos_2m), np.nan)

    def by_bisection(lat1, lat2, span):
        """For nearly opposite points: the azimuth that meets the longitude.

        With the first point in the south and at least as far from the equator,
        the longitude at which a geodesic first reaches the second latitude
        grows with its azimuth.
        """
        swap = np.abs(lat1) < np.abs(lat2)
        lat1, lat2 = np.where(swap, lat2, lat1), np.where(swap, lat1, lat2)
        side = np.where(lat1 > 0, -1.0, 1.0)
        su1, cu1 = reduced(lat1 * side)
        su2, cu2 = reduced(lat2 * side)
        su1 = np.minimum(su1, -1e-200)
        target = np.abs(span)

        def shoot(azimuth):
            sin_alpha = np.sin(azimuth) * cu1
            cos2_alpha = np.cos(azimuth) ** 2 + (np.sin(azimuth) * su1) ** 2
            north1 = np.cos(azimuth) * cu1
            north2 = np.sqrt(np.maximum(0.0, north1**2 + cu2**2 - cu1**2))
            sigma1, sigma2 = np.arctan2(su1, north1), np.arctan2(su2, north2)
            omega = np.arctan2(sin_alpha * su2, north2) - np.arctan2(sin_alpha * su1, north1)
            sigma, cos_2m = sigma2 - sigma1, np.cos(sigma1 + sigma2)
            reached = longitude(omega, sigma, sin_alpha, cos2_alpha, cos_2m)
            return reached, length(sigma, cos2_alpha, cos_2m)

        low, high = np.zeros(span.shape), np.full(span.shape, np.pi)
        for _ in range(60):
            middle = (low + high) / 2
            short = shoot(middle)[0] < target
            low, high = np.where(short, middle, low), np.where(short, high, middle)
        return shoot(high)[1]

    def vincenty_km(lat1, lon1, lat2, lon2, steps: int = 50):
        """Geodesic distance on the WGS-84 ellipsoid: Vincenty's inverse (1975).

        Arrays in, array out.  Equal points give 0; NaN marks missing input and
        latitudes beyond the poles.  Nearly opposite points, on which the
        iteration does not settle, are solved by bisection with the same series.
        """
        lat1, lon1, lat2, lon2 = np.broadcast_arrays(
            *(np.asarray(v, dtype=float) for v in (lat1, lon1, lat2, lon2))
        )
        with np.errstate(all="ignore"):
            # Longitude difference brought to [-180, 180).
            span = np.radians((lon2 - lon1 + 180) % 360 - 180)
            valid = (np.abs(lat1) <= 90) & (np.abs(lat2) <= 90) & ~np.isnan(span)
            km = np.array(by_iteration(lat1, lat2, span, steps))
            left = valid & np.isnan(km)
            if left.any():
                km[left] = by_bisection(lat1[left], lat2[left], span[left])
            return np.where(valid, km, np.nan)

    return vincenty_km


vincenty_km = _solver()


def _geodesic_udf():
    solve = vincenty_km

    def geodesic_km(
        lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series
    ) -> pd.Series:
        return pd.Series(solve(lat1, lon1, lat2, lon2))

    return F.pandas_udf(geodesic_km, DoubleType())


# Vincenty's distance on Arrow batches; null where there is none.
geodesic_km = _geodesic_udf()


def distance_km(lat1, lon1, lat2, lon2, model: str = "geodesic") -> Column:
    columns = [F.col(c) if isinstance(c, str) else c for c in (lat1, lon1, lat2, lon2)]
    if model == "geodesic":
        return geodesic_km(*columns)
    if model == "haversine":
        return haversine_km(*columns)
    raise ValueError(f"unknown distance model {model!r}; choose one of {MODELS}")


def with_distance_km(
    df: DataFrame,
    lat1,
    lon1,
    lat2,
    lon2,
    model: str = "geodesic",
    name: str = "distance_km",
) -> DataFrame:
    """Adds the distance of two points as a column; no row leaves the JVM for it."""
    if model == "geodesic":
        from beatmetrics.functions.geodesic import with_geodesic_km

        ends = [F.col(c) if isinstance(c, str) else c for c in (lat1, lon1, lat2, lon2)]
        return with_geodesic_km(df, *ends, name)
    return df.withColumn(name, distance_km(lat1, lon1, lat2, lon2, model))


def register_functions(spark: SparkSession) -> None:
    """Makes the distance and the day segment callable from SQL text."""
    spark.udf.register("geodesic_km", geodesic_km)
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION day_segment(time_text STRING)
        RETURNS STRING
        RETURN CASE
          WHEN try_cast(substring(time_text, 1, 2) AS INT) IS NULL THEN 'UNKNOWN'
          WHEN try_cast(substring(time_text, 1, 2) AS INT) BETWEEN 5 AND 11 THEN 'MORNING'
          WHEN try_cast(substring(time_text, 1, 2) AS INT) BETWEEN 12 AND 16 THEN 'AFTERNOON'
          WHEN try_cast(substring(time_text, 1, 2) AS INT) BETWEEN 17 AND 20 THEN 'EVENING'
          ELSE 'NIGHT' END
        """
    )

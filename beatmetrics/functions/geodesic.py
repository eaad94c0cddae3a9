"""The geodesic distance in built-in columns.

Vincenty's inverse with a fixed number of steps, one small projection after the
other, so that no expression is written out twice.  The error shrinks by the
flattening with every step; four settle all points but nearly opposite ones.
For these the azimuth is found by bisection, inside the branch that only they
take.  No row leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatmetrics.functions.distance import WGS84_FLATTENING, WGS84_MAJOR_KM

STEPS = 4
# A last step in longitude below this leaves an error of a hundredth of a millimetre.
SETTLED = 1e-9
HALVINGS = 60

_F = WGS84_FLATTENING
_MINOR_KM = WGS84_MAJOR_KM * (1 - _F)
_SECOND = (WGS84_MAJOR_KM**2 - _MINOR_KM**2) / _MINOR_KM**2


def _let(values: dict[str, Column], body) -> Column:
    """The body on named values that are computed once."""
    bound = F.struct(*[v.alias(k) for k, v in values.items()])
    return F.transform(F.array(bound), lambda x: body(*[x[k] for k in values]))[0]


def _correction(cos2_alpha: Column) -> Column:
    return _F / 16 * cos2_alpha * (4 + _F * (4 - 3 * cos2_alpha))


def _longer(sin_alpha, c, sigma, sin_s, cos_s, cos_2m) -> Column:
    """What the longitude on the sphere has above that on the ellipsoid."""
    turn = cos_2m + c * cos_s * (2 * cos_2m * cos_2m - 1)
    return (1 - c) * _F * sin_alpha * (sigma + c * sin_s * turn)


def _length(u_sq, sigma, sin_s, cos_s, cos_2m) -> Column:
    """Length of an arc of the auxiliary sphere; ``u_sq`` should be a column by itself."""
    big_a = 1 + u_sq / 16384 * (4096 + u_sq * (u_sq * (320 - 175 * u_sq) - 768))
    big_b = u_sq / 1024 * (256 + u_sq * (u_sq * (74 - 47 * u_sq) - 128))

    third = big_b / 6 * cos_2m * (4 * sin_s * sin_s - 3) * (4 * cos_2m * cos_2m - 3)
    second = big_b / 4 * (cos_s * (2 * cos_2m * cos_2m - 1) - third)
    return _MINOR_KM * big_a * (sigma - big_b * sin_s * (cos_2m + second))


def _by_bisection(su1, cu1, su2, cu2, span) -> Column:
    """With the first point in the south and at least as far from the equator, the
    longitude at which a geodesic first reaches the second latitude grows with its azimuth."""

    def turned(s1, c1, s2, c2):
        swap = F.abs(s1) < F.abs(s2)
        first, other = F.when(swap, s2).otherwise(s1), F.when(swap, s1).otherwise(s2)
        side = F.when(first > 0, -1.0).otherwise(1.0)
        return {
            "s1": F.least(first * side, F.lit(-1e-200)),
            "c1": F.when(swap, c2).otherwise(c1),
            "s2": other * side,
            "c2": F.when(swap, c1).otherwise(c2),
            "far": F.abs(span),
        }

    def solved(s1, c1, s2, c2, far):
        def shoot(azimuth: Column, body) -> Column:
            def arcs(sin_a, cos_a):
                north = cos_a * c1
                return _let(
                    {
                        "sin_alpha": sin_a * c1,
                        "cos2_alpha": cos_a * cos_a + sin_a * s1 * (sin_a * s1),
                        "north1": north,
                        "north2": F.sqrt(F.greatest(F.lit(0.0), north * north + c2 * c2 - c1 * c1)),
                    },
                    angles,
                )

            def angles(sin_alpha, cos2_alpha, north1, north2):
                first, second = F.atan2(s1, north1), F.atan2(s2, north2)
                return _let(
                    {
                        "sin_alpha": sin_alpha,
                        "cos2_alpha": cos2_alpha,
                        "omega": F.atan2(sin_alpha * s2, north2) - F.atan2(sin_alpha * s1, north1),
                        "sigma": second - first,
                        "cos_2m": F.cos(first + second),
                        "c": _correction(cos2_alpha),
                    },
                    body,
                )

            return _let({"sin_a": F.sin(azimuth), "cos_a": F.cos(azimuth)}, arcs)

        def reached(sin_alpha, cos2_alpha, omega, sigma, cos_2m, c):
            return omega - _longer(sin_alpha, c, sigma, F.sin(sigma), F.cos(sigma), cos_2m)

        def halved(ends, _):
            middle = (ends["low"] + ends["high"]) / 2
            short = shoot(middle, reached) < far
            return F.struct(
                F.when(short, middle).otherwise(ends["low"]).alias("low"),
                F.when(short, ends["high"]).otherwise(middle).alias("high"),
            )

        start = F.struct(F.lit(0.0).alias("low"), F.lit(math.pi).alias("high"))
        azimuth = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, halved)["high"]
        return shoot(
            azimuth,
            lambda sin_alpha, cos2_alpha, omega, sigma, cos_2m, c: _let(
                {"u_sq": cos2_alpha * _SECOND, "sigma": sigma, "cos_2m": cos_2m},
                lambda u, s, m: _length(u, s, F.sin(s), F.cos(s), m),
            ),
        )

    return _let(turned(su1, cu1, su2, cu2), solved)


def with_geodesic_km(
    df: DataFrame, lat1: Column, lon1: Column, lat2: Column, lon2: Column, name: str
) -> DataFrame:
    """Adds the geodesic distance of two points in degrees; null without a valid place.

    Other columns stay as they are; one called ``name`` is replaced.
    """
    mark = "_g"
    while any(c.lower().startswith(mark) for c in df.columns):
        mark = "_" + mark

    def own(column: str) -> str:
        return f"{mark}_{column}"

    def get(columns: str) -> list[Column]:
        return [F.col(own(c)) for c in columns.split()]

    def add(frame: DataFrame, **columns: Column) -> DataFrame:
        return frame.withColumns({own(k): v for k, v in columns.items()})

    def degrees(column: Column) -> Column:
        return F.coalesce(column.cast("double"), F.lit(math.nan))

    # Generated code beyond 8,000 bytes a method is interpreted.  So what follows has
    # no nulls, and a value bound by a lambda keeps it apart from what stands before.
    ends = {"lat1": degrees(lat1), "lon1": degrees(lon1), "lat2": degrees(lat2)}
    out = add(df, ends=_let(ends | {"lon2": degrees(lon2)}, F.struct))
    (ends,) = get("ends")
    y1, x1, y2, x2 = (
        F.coalesce(ends[c], F.lit(math.nan)) for c in ("lat1", "lon1", "lat2", "lon2")
    )
    out = add(out, y1=y1, y2=y2, turn=x2 - x1 + 180.0)
    y1, y2, turn = get("y1 y2 turn")
    out = add(
        out,
        t1=(1 - _F) * F.tan(F.radians(y1)),
        t2=(1 - _F) * F.tan(F.radians(y2)),
        span=F.radians(turn - 360.0 * F.floor(turn / 360.0).cast("double") - 180.0),
    )
    t1, t2, span = get("t1 t2 span")
    out = add(out, cu1=1 / F.sqrt(1 + t1 * t1), cu2=1 / F.sqrt(1 + t2 * t2), lam=span)
    cu1, cu2, lam, before = get("cu1 cu2 lam before")
    out = add(out, su1=t1 * cu1, su2=t2 * cu2)
    su1, su2, ss, cu, x, y, sl, cl, n = get("su1 su2 ss cu x y sl cl n")
    out = add(out, ss=su1 * su2, cu=cu1 * cu2, x=cu1 * su2, y=su1 * cu2)
    sine, cosine, sg, sa, ca, cm, c = get("sine cosine sg sa ca cm c")
    for step in range(STEPS + 1):
        out = add(out, sl=F.sin(lam), cl=F.cos(lam))
        out = add(out, n=x - y * cl, sl=cu2 * sl)
        out = add(out, sine=F.sqrt(sl * sl + n * n), cosine=ss + cu * cl)
        # Equal points have no sine, and the numerator is 0 too.
        out = add(out, sg=F.atan2(sine, cosine), sa=cu1 * sl / (sine + 1e-300))
        if step == 0:
            # A first step to the first order of the flattening loses nothing.
            out = add(out, lam=span + _F * sa * sg)
            continue
        out = add(out, ca=1 - sa * sa)
        # Along the equator ca is 0 and the term drops out.
        out = add(
            out,
            cm=F.when(ca < 1e-15, 0.0).otherwise(cosine - 2 * ss / (ca + 1e-300)),
            c=_correction(ca),
        )
        if step == 1:
            # Nor does the second order in the second step.
            out = add(out, lam=span + (1 - c) * _F * sa * (sg + c * sine * cm))
        elif step < STEPS:
            out = add(out, before=lam, lam=span + _longer(sa, c, sg, sine, cosine, cm))
    out = add(out, u=ca * _SECOND)
    settled = (F.abs(lam - before) < SETTLED) & (F.abs(lam) <= math.pi)
    km = F.when(settled, _length(F.col(own("u")), sg, sine, cosine, cm)).otherwise(
        _by_bisection(su1, cu1, su2, cu2, span)
    )
    valid = (F.abs(y1) <= 90) & (F.abs(y2) <= 90) & ~F.isnan(span)
    kept = [c for c in df.columns if c != name]
    return out.select(*[F.col(f"`{c}`") for c in kept], F.when(valid, km).alias(name))

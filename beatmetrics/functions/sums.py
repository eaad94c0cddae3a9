"""Sums and means of doubles that do not depend on the order of the rows.

A sum of doubles changes with the partitioning, and a mean rounded to three
decimals can change with it.  Here each value becomes a whole number of 2**-40
units, cut into limbs of 19 bits that are summed as longs; what is carried from
limb to limb is only worked out once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 2**40
LIMB_BITS = 19
LIMBS = 3
# Values beyond this do not fit the limbs.
LARGEST = 2 ** (LIMB_BITS * LIMBS - 1 - 40)


def _units(value: Column) -> Column:
    """The value in units, as a long; null for null, NaN and what is too large."""
    fits = F.abs(value) < LARGEST
    return F.when(fits, F.rint(value * float(UNITS)).cast("long"))


def exact_sum(value: Column, times: Column | None = None) -> Column:
    """The sum of a double column, each value counted ``times`` times, as a decimal of units.

    Exact for up to 2**43 counted rows.  Values of 2**16 or more in absolute
    value, NaN and null are left out; without any value the sum is null.
    """
    units = _units(value)
    times = F.lit(1) if times is None else times
    total = None
    for limb in range(LIMBS):
        low = F.shiftright(units, LIMB_BITS * limb)
        part = low if limb == LIMBS - 1 else low.bitwiseAND(F.lit(2**LIMB_BITS - 1))
        summed = F.sum(part * times).cast("decimal(38,0)") * F.lit(2 ** (LIMB_BITS * limb)).cast(
            "decimal(18,0)"
        )
        total = summed if total is None else total + summed
    return total


def exact_mean(value: Column, times: Column | None = None) -> Column:
    """The mean by :func:`exact_sum`, as a double; null without a value."""
    times = F.lit(1) if times is None else times
    counted = F.sum(F.when(_units(value).isNotNull(), times))
    return F.try_divide(exact_sum(value, times).cast("double"), counted * float(UNITS))

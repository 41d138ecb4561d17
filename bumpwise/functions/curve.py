"""A space-filling curve as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 26
# fixed values: masks that leave room for one more bit after each bit of a number of 32 bits
_SPREAD = (
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
)


def place_on_curve(lon: Column, lat: Column) -> Column:
    """Number of the place's cell on a Z-order curve over the globe: near numbers are near places.

    The globe is parted into 2**26 steps each way, about half a metre. Places without coordinates,
    or outside the globe, are -1.
    """

    def spread(value: Column, low: float, high: float) -> Column:
        step = F.floor((value - low) / (high - low) * float(2**_BITS))
        bits = F.least(step, F.lit(2**_BITS - 1)).cast("long")
        for shift, mask in _SPREAD:
            bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return bits

    inside = lon.between(-180, 180) & lat.between(-90, 90)
    both = F.shiftleft(spread(lon, -180.0, 180.0), 1).bitwiseOR(spread(lat, -90.0, 90.0))
    return F.when(inside, both).otherwise(F.lit(-1).cast("long"))

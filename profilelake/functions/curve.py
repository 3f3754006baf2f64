"""A key along a space-filling curve, for clustering by several columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 16

# Spreading a number's 16 bits: at each step a shift, then the mask of the bits that stay.
_SPREAD = {
    2: ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)),
    3: ((16, 0x0000FF0000FF), (8, 0x00F00F00F00F), (4, 0x0C30C30C30C3), (2, 0x249249249249)),
}


def cell(value: Column, low: float, high: float) -> Column:
    """The number, 0 to 65,535, of a value's cell in a range; null and NaN give 0."""
    top = (1 << BITS) - 1
    width = float(high) - float(low)
    number = value.cast("double")
    if not width > 0:
        return F.lit(0).cast("bigint")
    share = (number - F.lit(float(low))) / F.lit(width)
    inside = F.least(F.greatest(F.floor(share * top), F.lit(0)), F.lit(top)).cast("bigint")
    return F.when(number.isNull() | F.isnan(number), 0).otherwise(inside).cast("bigint")


def interleaved(cells: Sequence[Column]) -> Column:
    """The bits of one, two or three cell numbers in turn: near keys are near in all of them."""
    if len(cells) == 1:
        return cells[0]
    if len(cells) not in _SPREAD:
        raise ValueError("a curve takes one to three columns")

    def spread(x: Column) -> Column:
        for shift, mask in _SPREAD[len(cells)]:
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
        return x

    key = spread(cells[0])
    for k, x in enumerate(cells[1:], 1):
        key = key.bitwiseOR(F.shiftleft(spread(x), k))
    return key

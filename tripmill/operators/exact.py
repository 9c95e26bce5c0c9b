"""Sums of doubles that do not depend on the order of the rows.

Adding doubles rounds at every step, so the last digits of a total change with the partitioning, and with
them ranks of near ties and values that are rounded for display. Here every volume is cut into whole tons
and three fractions of ``BITS`` bits, all exact, which are added as integers; the total is put together
from the integer sums at the end. Partial sums merge exactly, at any number of steps.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 22
#: Loads of so many tons or more, which are no loads, are added as doubles beside the others.
LARGEST = float(1 << 23)
# Fraction bits that fit in a long beside the whole tons, and those of them that belong to the second part.
_HEAD, _LOW = 40, 40 - BITS
LIMBS = ("volume_whole", "volume_part1", "volume_part2", "volume_part3", "volume_beyond")


def limbs(volume: Column) -> list[Column]:
    """The parts of a volume, null where it is null. What lies below 2^-66 tons is cut off.

    Doubles of less than ``LARGEST`` are cut without rounding: scaling by a power of two and taking off the
    whole part are exact, and 63 bits of the scaled number are cut as an integer.
    """
    negative = volume < 0
    inside = F.abs(volume) < LARGEST
    scaled = F.abs(F.when(inside, volume)) * 2.0**_HEAD
    head = F.floor(scaled)
    tail = (scaled - head) * 2.0 ** (2 * BITS - _HEAD)
    low = F.lit((1 << _LOW) - 1).cast("bigint")
    parts = [
        F.shiftright(head, _HEAD),
        F.shiftright(head, _LOW).bitwiseAND(F.lit((1 << BITS) - 1).cast("bigint")),
        F.shiftleft(head.bitwiseAND(low), BITS - _LOW) + F.floor(tail),
        F.floor((tail - F.floor(tail)) * 2.0**BITS),
    ]
    return [*[F.when(negative, -part).otherwise(part) for part in parts], F.when(~inside, volume)]


def total(sums: Sequence[Column]) -> Column:
    """The double of summed limbs, 0.0 if there were none.

    Carries are passed up first, so that equal totals have equal limbs, whatever they were added from.
    """
    zero = F.lit(0).cast("bigint")
    whole, *parts = [F.coalesce(s, zero) for s in sums[:4]]
    carried, carry = [], zero
    for part in reversed(parts):
        part = part + carry
        carry = F.shiftright(part, BITS)
        carried.append(part - F.shiftleft(carry, BITS))
    value = F.lit(0.0)
    for i, part in zip((3, 2, 1), carried, strict=True):
        value = value + part.cast("double") * 2.0 ** (-BITS * i)
    value = value + (whole + carry).cast("double")
    return value + F.coalesce(sums[4], F.lit(0.0))


def summed_limbs(of: Sequence[Column], only: Callable[[Column], Column] = lambda c: c) -> list[Column]:
    """Aggregates of limb columns; ``only`` may leave rows out."""
    return [F.sum(only(c)) for c in of]

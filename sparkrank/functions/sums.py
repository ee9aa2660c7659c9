"""Sums of doubles that do not depend on the order of their rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A value is cut into whole multiples of these; what is below the last one is dropped.
STEPS = (2.0**-20, 2.0**-50, 2.0**-80)


def exact_sum(value: Column) -> Column:
    """The sum of ``value`` over a group, the same to the last bit however rows are dealt or merged.

    Cutting a double into three whole numbers loses nothing down to 2**-80, and whole numbers add up
    exactly in any order, map-side sums included. Sums of magnitudes stay below 2**43 and rows of a
    group below 2**33; beyond that the job fails under ANSI mode instead of wrapping round. Nulls
    are left out, and a group of nulls sums to null; NaN and infinite values are not summed.
    """
    total, rest, above = None, value.cast("double"), 1.0
    for step in STEPS:
        scaled = rest * F.lit(above / step)
        whole = F.floor(scaled)
        rest, above = scaled - whole, step
        part = F.sum(whole).cast("double") * F.lit(step)
        total = part if total is None else total + part
    return total

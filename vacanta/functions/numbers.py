"""Ratios and rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as double, 0 when there is nothing to divide by."""
    ratio = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return F.coalesce(ratio * 100, F.lit(0.0))


def round_exact(x: Column, digits: int) -> Column:
    """Round half-even on the exact binary value of a double, as a decimal.

    ``round`` and ``bround`` work on the shortest decimal text, so 2.675 (really
    2.67499999...) becomes 2.68. Here the value is split into whole 2**-26 steps,
    which doubles hold without error, and rounded as whole numbers. Exact for
    magnitudes from 1 to 1e9; below 1, bits under 2**-52 are left out.
    """
    step = float(2**26)
    size = F.abs(x)
    whole = F.floor(size)
    high = F.floor((size - whole) * step)
    low = F.floor(((size - whole) * step - high) * step)
    unit = F.lit(2**52).cast("decimal(16,0)")
    bits = (
        whole.cast("decimal(10,0)") * unit
        + high.cast("decimal(9,0)") * F.lit(2**26).cast("decimal(9,0)")
        + low.cast("decimal(9,0)")
    ).cast("decimal(27,0)")
    scaled = (bits * F.lit(10**digits).cast("decimal(5,0)")).cast("decimal(33,0)")
    down = F.call_function("div", scaled, unit)
    rest2 = (scaled % unit).cast("decimal(18,0)") * 2
    up = (rest2 > unit) | ((rest2 == unit) & (down % 2 == 1))
    rounded = (down + up.cast("int")).cast("decimal(18,0)")
    signed = F.when(x < 0, -rounded).otherwise(rounded)
    return (signed / F.lit(10**digits).cast("decimal(5,0)")).cast(f"decimal(18,{digits})")

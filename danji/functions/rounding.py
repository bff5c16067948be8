"""Rounding that agrees with SQL ROUND on doubles and with half-even decimal rounding.

Spark's own round/bround work on the decimal text of a double, which moves ties: 1.005
prints as 1.005 but is stored below it. These helpers work on the stored value.
"""

from pyspark.sql import Column, functions as F


def round_half_up(c: Column, digits: int) -> Column:
    """Half away from zero after scaling, all in double arithmetic."""
    scale = float(10**digits)
    x = c.cast("double")
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale


def round1_half_even(c: Column) -> Column:
    """One decimal; ties are judged on the exact binary value, exact ties go to even.

    10x is 8x + 2x, both exact, so the error of their sum is recovered exactly and says on
    which side of a .5 the true value lies.
    """
    x = F.abs(c.cast("double"))
    ten = x * 8.0 + x * 2.0
    error = x * 2.0 - (ten - x * 8.0)
    whole = F.floor(ten)
    rest = ten - whole
    up = (rest > 0.5) | (
        (rest == 0.5) & ((error > 0.0) | ((error == 0.0) & (whole % 2 == 1)))
    )
    tenths = F.when(up, whole + 1).otherwise(whole)
    return F.signum(c.cast("double")) * tenths / 10.0


def round0_half_even(c: Column) -> Column:
    return F.rint(c.cast("double")).cast("int")

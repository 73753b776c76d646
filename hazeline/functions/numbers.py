"""Rounding, exact means and number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int = 0) -> Column:
    """Round to ``digits`` with ties to even (``round`` sends ties away from zero)."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def whole(value: Column) -> Column:
    """Nearest integer, ties to even; a bare cast would cut the fraction off."""
    return F.rint(value).cast("int")


def exact_mean(value: Column) -> Column:
    """Mean without nulls and NaN that does not depend on the order rows arrive in.

    A sum of doubles shifts by a few last bits with the order of partial sums, enough to flip a
    rounded tie between two runs. So values are added up as whole millionths. They are split in
    two at bit 20, which leaves room for some 10^12 rows a group where one sum of longs would
    overflow; decimals would do too but take ten times as long. A group with a value that millionths do
    not hold (infinite, beyond 9e12, or with more decimals) takes the plain mean.
    """
    number = value.cast("double")
    number = F.when(~F.isnan(number), number)
    held = F.abs(number) < F.lit(9e12)
    scaled = F.when(held, F.rint(number * F.lit(1e6)))
    millionths = scaled.cast("bigint")
    plain = ~held | (F.abs(number - scaled / F.lit(1e6)) > F.lit(1e-9))
    high = F.sum(F.shiftright(millionths, 20))
    low = F.sum(millionths.bitwiseAND(F.lit((1 << 20) - 1)))
    count = F.nullif(F.count(number), F.lit(0))
    # below 2^53 a double holds the sum exactly; both ways give the same, correctly rounded total
    small = (high * F.lit(1 << 20) + low).cast("double") / F.lit(1e6)
    unit, millionth = F.lit(1 << 20).cast("decimal(7,0)"), F.lit("0.000001").cast("decimal(6,6)")
    large = (high.cast("decimal(19,0)") * unit + low.cast("decimal(19,0)")) * millionth
    fits = high.between(-(1 << 32), 1 << 32) & low.between(0, 1 << 52)
    exact = F.when(fits, small).otherwise(large.cast("double")) / count
    return F.when(F.max(F.coalesce(plain, F.lit(False))), F.avg(number)).otherwise(exact)


def fixed(value: Column, digits: int) -> Column:
    """Text with that many decimals, rounded half-even on the exact binary value; NaN gives null."""
    pattern = "0" if digits == 0 else "0." + "0" * digits
    return F.when(~F.isnan(value), F.call_function("format_number", value, F.lit(pattern)))


def signed_whole(value: Column) -> Column:
    """Whole number with its sign always shown."""
    return F.call_function("format_number", value, F.lit("+0;-0"))

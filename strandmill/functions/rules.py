"""Gates, ratios, votes and renderings. A null gate is false; a null proportion stays null."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = F.lit

def safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)

def coverage_ratio(real: Column, control: Column, n: Column) -> Column:
    """real / control; +Inf without control hits, null without either or without windows."""
    return F.when(n > 0, F.when(control > 0, (real / n) / (control / n)).when(real > 0, F.lit(float("inf"))))

def midpoint(start: Column, stop: Column, flank: int) -> Column:
    return (start + stop) / 2 - (flank + 1)

def is_central(start: Column, stop: Column, flank: int, radius: int) -> Column:
    return F.abs(midpoint(start, stop, flank)) <= radius

def is_exact_center(start: Column, stop: Column, flank: int) -> Column:
    return (start <= flank + 1) & (stop >= flank + 1)

def supported(ratio: Column, difference: Column, central_difference: Column, ratio_min: float, central: bool = False, evalue: Column | None = None, e_max: float | None = None) -> Column:
    """Strictly over every threshold."""
    gate = (ratio > ratio_min) & (difference > 0)
    if central:
        gate &= central_difference > 0
    if e_max is not None:
        gate &= evalue < e_max
    return F.coalesce(gate, F.lit(False))

def ceil_float(fraction: float, n: Column) -> Column:
    """Ceiling of the double product."""
    return F.ceil(F.lit(float(fraction)) * n).cast("bigint")

def ceil_rational(fraction: str, n: Column) -> Column:
    """Ceiling of the exact product of a decimal fraction."""
    f = Fraction(fraction)
    over = F.lit(f.numerator) * n + (f.denominator - 1)
    return ((over - over % f.denominator) / f.denominator).cast("bigint")


def percent(count: Column, n: Column) -> Column:
    """100 * count / n with six decimals."""
    return F.format_string("%.6f", 100 * count / n)

def strand_order(strand: Column) -> Column:
    return F.when(strand == "+", 0).otherwise(1)

def number(text: Column) -> Column:
    """'', NA and None are null, Inf is +Inf."""
    return F.when(~text.isin("", "NA", "None"), text.try_cast("double"))

def display(value: Column) -> Column:
    """null and -Inf as NA, +Inf as Inf."""
    text = value.cast("string")
    return F.when(value.isNull() | text.isin("-Infinity"), "NA").when(text == "Infinity", "Inf").otherwise(text)

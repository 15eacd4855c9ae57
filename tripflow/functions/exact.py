"""Order-independent numeric aggregates.

A plain ``round(avg(x), 2)`` over doubles depends on the order of the float
additions, which differs between partitions, engines and runs, and it flips
the last rounded digit on a few groups.  These helpers quantise each value to
an integer first, add integers (exact, associative, so partial/final
aggregation can combine in any order), and round once at the end with a
half-up rule that every engine evaluates identically:

    round_half_up(x, n) = floor(x * 10^n + 0.5) / 10^n

All of them are built-in expressions (codegen, map-side partial aggregation).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quantum for averaging ratios (speed, tip %, minutes): 1e-6.
RATIO_DIGITS = 6
# Values of this magnitude or more (NaN and infinities too) are no
# measurements: they count as NULL, so that units fit a bigint.
TOO_LARGE = 1e12


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def measured(col) -> Column:
    """The value, or NULL where it is NaN, infinite or beyond ``TOO_LARGE``."""
    return F.when(F.abs(_c(col)) < TOO_LARGE, _c(col))


def round_half_up(col, n: int) -> Column:
    scale = float(10 ** n)
    return F.floor(_c(col) * scale + 0.5) / scale


def fixed_units(col, digits: int) -> Column:
    """``col`` (a value with at most ``digits`` decimals) as an exact bigint."""
    return F.round(measured(col) * float(10 ** digits)).cast("bigint")


def ratio_units(col) -> Column:
    """``col`` quantised to 1e-6 as a decimal integer (no overflow at scale)."""
    return F.floor(measured(col) * float(10 ** RATIO_DIGITS) + 0.5).cast("decimal(38,0)")


def avg_of_units(units_sum: Column, n_values: Column, digits: int, out: int) -> Column:
    """sum / count in units, then to ``out`` decimals, half up."""
    mean_units = units_sum.cast("double") / F.nullif(n_values, F.lit(0))
    if digits >= out:
        scaled = mean_units / float(10 ** (digits - out))
    else:
        scaled = mean_units * float(10 ** (out - digits))
    return F.floor(scaled + 0.5) / float(10 ** out)


def avg_fixed(col, digits: int, out: int) -> Column:
    """Exact mean of a value with ``digits`` decimals (money: digits=2),
    rounded half up to ``out`` decimals."""
    return avg_of_units(F.sum(fixed_units(col, digits)), F.count(measured(col)), digits, out)


def avg_ratio(col, out: int) -> Column:
    """Mean of an arbitrary double quantised to 1e-6, rounded to ``out``."""
    return avg_of_units(F.sum(ratio_units(col)), F.count(measured(col)), RATIO_DIGITS, out)


def sum_fixed(col, digits: int) -> Column:
    """Exact sum of a value with ``digits`` decimals, as a double."""
    return F.sum(fixed_units(col, digits)).cast("double") / float(10 ** digits)


def pct(part, whole, out: int) -> Column:
    """part * 100 / whole, rounded half up to ``out`` decimals."""
    scale = float(10 ** out)
    return F.floor(_c(part) * 100.0 / F.nullif(_c(whole), F.lit(0)) * scale + 0.5) / scale

"""Energy units and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: below this a mains total (kWh) or a power (W) counts as nothing.
EPSILON = 1e-5


def joules_to_kwh(joules: Column) -> Column:
    return joules / F.lit(1000.0) / F.lit(3600.0)


def share_percent(part: Column, total: Column) -> Column:
    """100 * part / total; 0 where the total is missing or below EPSILON."""
    return F.when(total.isNull() | (total < F.lit(EPSILON)), F.lit(0.0)).otherwise(part / total * F.lit(100.0))


def two_decimals(value: Column) -> Column:
    """Text with two decimals, rounded half-even on the exact binary value as C's '%.2f' does."""
    return F.call_function("format_number", value, F.lit("0.00"))

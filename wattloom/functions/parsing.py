"""Text to number, null instead of a failed job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: letters of number forms that Java takes and no meter sends ('1d', '2f', '0x1p3').
JAVA_NUMBER_LETTERS = "[dDfFxX]"


def parse_seconds(text: Column) -> Column:
    """A whole number; '1.5' and '1e3' are none."""
    return text.try_cast("bigint")


def parse_power(text: Column) -> Column:
    """A finite decimal number; NaN and Infinity are no readings."""
    value = text.try_cast("double")
    return F.when((F.abs(value) < F.lit(float("inf"))) & ~text.rlike(JAVA_NUMBER_LETTERS), value)

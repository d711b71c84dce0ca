"""Calendar and day arithmetic over whole epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400

# Date and date-time formats of the serving tables, the short report and the anchors.
DATE_FORMAT = "yyyy-MM-dd"
SHORT_DATE_FORMAT = "MM/dd/yy"
ANCHOR_FORMAT = "MM/dd/yyyy:HH:mm:ss"


def ts_to_date(ts: Column, pattern: str = DATE_FORMAT) -> Column:
    """Epoch seconds to a date string in spark.sql.session.timeZone."""
    return F.from_unixtime(ts, pattern)


def day_floor(ts: Column) -> Column:
    """Start of the UTC day that holds ``ts``."""
    return ts - F.pmod(ts, F.lit(DAY))


def bucket_floor(ts: Column, width: int, anchor: Column | int = 0) -> Column:
    """Start of the ``width``-second bucket, counted from ``anchor``, that holds ``ts``."""
    start = F.lit(anchor) if isinstance(anchor, int) else anchor
    return ts - F.pmod(ts - start, F.lit(width))


def day_index(ts: Column, anchor: Column | int = 0) -> Column:
    """Number of whole 86,400 s days between ``anchor`` and ``ts``."""
    start = F.lit(anchor) if isinstance(anchor, int) else anchor
    return F.floor((ts - start) / F.lit(DAY)).cast("bigint")


def parse_anchor(text: Column | str) -> Column:
    """'MM/dd/yyyy:HH:mm:ss' in the session zone to epoch seconds; null where it does not parse."""
    column = F.lit(text) if isinstance(text, str) else text
    return F.unix_timestamp(F.try_to_timestamp(column, F.lit(ANCHOR_FORMAT)))

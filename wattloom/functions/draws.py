"""Repeatable draws: the same key and seed give the same value on every run and every retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: int, *keys: Column) -> Column:
    """MD5 of the key values and the seed, as hex text. Any SQL engine gives the same."""
    return F.md5(F.concat_ws("|", *[key.cast("string") for key in keys], F.lit(str(seed))).cast("binary"))


def unit_draw(seed: int, *keys: Column) -> Column:
    """Uniform in [0, 1) from the first 32 bits of the digest. Meant for dimension-sized data."""
    return F.conv(F.substring(digest(seed, *keys), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)

"""Power overshoot against the stored percentile of the meter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METER = ["house_id", "meter_id"]


def overshoot_alerts(readings: DataFrame, stats: DataFrame, margin: float = 0.0, salts: int = 1) -> DataFrame:
    """Readings above ``p97 * (1 + margin)``; a meter without statistics never alerts.

    ``readings`` may be a stream and ``stats`` a static table. Spark broadcasts the statistics when
    their measured size allows it. In a batch plan AQE splits a busy meter when they are too big;
    a stream has no such step, so ``salts`` spreads each meter over that many join keys and repeats
    its one row of statistics as often.
    """
    bounds = stats.select(*METER, "p97")
    keys = list(METER)
    rows = readings.select(*[c for c in readings.columns if c != "p97"])
    if salts > 1:
        keys.append("salt")
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("ts", "power"), F.lit(salts)).cast("int"))
        bounds = bounds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        rows.join(bounds, keys)
        .where(F.col("power") > F.col("p97") * F.lit(1.0 + margin))
        .select("ts", "house_id", "meter_id", "power", "p97")
    )

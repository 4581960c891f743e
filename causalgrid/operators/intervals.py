"""Events with a start and a stop, spelled out per hour."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expand_hours(
    events: DataFrame,
    period_start: Column | datetime,
    period_end: Column | datetime,
    start: str = "event_start",
    stop: str = "event_stop",
    at: str = "timestamp_utc",
) -> DataFrame:
    """One row per event and hour in ``[start, stop)`` cut to the period; others disappear."""
    low = F.greatest(F.col(start), period_start if isinstance(period_start, Column) else F.lit(period_start))
    high = F.least(F.col(stop), period_end if isinstance(period_end, Column) else F.lit(period_end))
    inside = events.withColumn("_low", low).withColumn("_high", high).where("_low < _high")
    hours = F.sequence("_low", "_high", F.expr("INTERVAL 1 HOUR"))
    spelled = inside.withColumn(at, F.explode(hours)).where(F.col(at) < F.col("_high"))
    return spelled.drop("_low", "_high")


def hourly_outages(expanded: DataFrame) -> DataFrame:
    """Unavailable MW and number of distinct units per (zone, hour).

    Summed per unit first: partial sums leave the map side, never lists of units.
    """
    per_unit = expanded.groupBy("zone", "timestamp_utc", "unit").agg(F.sum("unavailable_mw").alias("mw"))
    return per_unit.groupBy("zone", "timestamp_utc").agg(
        F.coalesce(F.sum("mw"), F.lit(0.0)).alias("outage_mw"), F.count("unit").cast("int").alias("active_unit_count")
    )

"""Aggregations that bring sources to the (zone, time) grain, and merges of such tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causalgrid.functions import periods
from causalgrid.operators import dims
from causalgrid.operators.keys import null_safe_join
from causalgrid.operators.quantiles import exact_quantiles

METRICS = ("load_mw", "imbalance_mwh", "price_eur_mwh")


def _zonal(df: DataFrame, mapping: DataFrame, period: str) -> DataFrame:
    """Rows with a period and a zone; quarter strings are read, what cannot be read goes."""
    if dict(df.dtypes)[period] == "string":
        df = df.withColumn(period, periods.quarter_start(F.col(period)))
    zoned = dims.with_zone(df, mapping)
    return zoned.where(F.col(period).isNotNull() & F.col("bidding_zone").isNotNull())


def to_zone(df: DataFrame, mapping: DataFrame, value: str, func: str = "sum", period: str = "period_utc") -> DataFrame:
    """Municipalities to zones per period. The sum of nothing but NULL is zero.

    Medians of all groups are selected by counts at once, so no group's values meet in a buffer.
    """
    x, by = F.col(value), [period, "bidding_zone"]
    rows = _zonal(df, mapping, period)
    if func == "median":
        return null_safe_join(rows.select(*by).distinct(), exact_quantiles(rows, value, {value: 0.5}, by), by, "left")
    how: dict[str, Column] = {"sum": F.coalesce(F.sum(x), F.lit(0.0)), "mean": F.avg(x)}
    return rows.groupBy(*by).agg(how[func].alias(value))


def housing_quarters(
    df: DataFrame, mapping: DataFrame, period: str = "period_utc",
    construction: str = "smahus_construction_index", price: str = "smahus_price_index",
) -> DataFrame:
    """Both housing series per (period, zone) in one pass: construction adds up, prices average."""
    return _zonal(df, mapping, period).groupBy(period, "bidding_zone").agg(
        F.coalesce(F.sum(construction), F.lit(0.0)).alias(construction), F.avg(price).alias(price)
    )


def merge_cubes(construction: DataFrame, price: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two long tables side by side; rows of either survive."""
    return construction.join(price, list(keys), "full")


def merge_metrics(
    frames: dict[str, DataFrame], keys: Sequence[str] = ("zone", "timestamp_utc"), flag: str = "is_anomaly"
) -> DataFrame:
    """Load, imbalance and price side by side on (zone, time), flagged if any of them is.

    Stacked and aggregated: one shuffle for any number of metrics, where full joins would need
    one per metric. Each frame has one row per key (see ``regular.keep_first``).
    """
    names = list(frames)
    kept = [
        df.select(*keys, F.col(n).alias(n), *([flag] if flag in df.columns else [F.lit(False).alias(flag)]))
        for n, df in frames.items()
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept)
    return stacked.groupBy(*keys).agg(
        *[F.max(n).alias(n) for n in names], F.coalesce(F.bool_or(flag), F.lit(False)).alias(flag)
    )


def settle_weather(obs: DataFrame, keys: Sequence[str] = ("zone", "timestamp_utc"), order: Sequence[str] = ("station_id",)) -> DataFrame:
    """Several observations of one moment: means, any anomaly, the first station by ``order``, NULL last.

    Observations of one moment have no order of their own; without another one the least station is the first.
    """
    first = F.min_by("station_id", F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"n_{c}"), F.col(c))], F.col("station_id").alias("_tie")))
    station = [first.alias("station_id")] if "station_id" in obs.columns else []
    return obs.groupBy(*keys).agg(
        F.avg("temperature_c").alias("temperature_c"),
        F.avg("wind_speed_ms").alias("wind_speed_ms"),
        F.coalesce(F.bool_or("is_anomaly"), F.lit(False)).alias("is_anomaly"),
        *station,
    )


def merge_parameters(temperature: DataFrame, wind: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Temperature and wind of a station side by side; anomalous if either is.

    Each keeps its quality flag, as ``quality_flag_temp`` and ``quality_flag_wind``; the station is the temperature's, or the wind's where
    there is no temperature. Columns that neither side has are not made.
    """
    flag, quality, station = "is_anomaly", "quality_flag", "station_id"
    sides = {"_t": (temperature, "temperature_c", "quality_flag_temp"), "_w": (wind, "wind_speed_ms", "quality_flag_wind")}
    kept, extra = [], []
    for tag, (df, value, name) in sides.items():
        has = [(quality, name), (station, f"{tag}_station")]
        own = [F.col(c).alias(n) for c, n in has if c in df.columns and c not in keys]
        kept.append(df.select(*keys, value, F.col(flag).alias(tag), *own))
        extra += [name] if quality in df.columns else []
    joined = kept[0].join(kept[1], list(keys), "full")
    either = F.coalesce("_t", F.lit(False)) | F.coalesce("_w", F.lit(False))
    stations = [c for c in ("_t_station", "_w_station") if c in joined.columns]
    where = [F.coalesce(*stations).alias(station)] if stations else []
    return joined.select(*keys, "temperature_c", "wind_speed_ms", either.alias(flag), *extra, *where)

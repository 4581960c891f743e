"""Check every record, keep every record: failures are named, never dropped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causalgrid.functions import periods, text

# Bidding zones and the national limits behind the checks.
ZONES = ("SE1", "SE2", "SE3", "SE4")
LOAD_MW = (100.0, 30_000.0)
IMBALANCE_ABS_MWH = 5_000.0
PRICE_EUR = (-500.0, 4_000.0)
TEMPERATURE_C = (-50.0, 40.0)
WIND_MS = (0.0, 70.0)
POLICY_RATE_PCT = (-2.0, 15.0)
KOMMUNKOD = (114, 2584)
NET_POSITION_ABS_MW = 5_000.0
OUTAGE_MW = (0.0, 5_000.0)


def require_columns(df: DataFrame, needed: Sequence[str], what: str = "table") -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks {missing}; it has {sorted(df.columns)}")


def named_failures(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that do not hold; an undecidable rule does not hold."""
    marks = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return F.array_compact(F.array(*marks))


def validate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``failed_rules`` and ``is_valid``."""
    checked = df.withColumn("failed_rules", named_failures(rules))
    return checked.withColumn("is_valid", F.size("failed_rules") == 0)


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid rows without the marks, and the rejects with their reasons."""
    valid = checked.where("is_valid").drop("failed_rules", "is_valid")
    return valid, checked.where("not is_valid").drop("is_valid")


def zone_known(c: str = "zone") -> Column:
    return F.col(c).isin(*ZONES)


def _at(c: str = "timestamp_utc") -> Column:
    return F.col(c).isNotNull()


def load_rules() -> dict[str, Column]:
    return {
        "zone": zone_known(),
        "timestamp_utc": _at(),
        "load_mw": F.col("load_mw") >= 0,
        "resolution_minutes": F.col("resolution_minutes").between(1, 1440),
    }


def imbalance_rules() -> dict[str, Column]:
    return {"zone": zone_known(), "timestamp_utc": _at(), "imbalance_mwh": F.col("imbalance_mwh").isNotNull()}


def imbalance_warning() -> Column:
    """Sign and direction disagree: worth a note, no reason to reject."""
    up = (F.col("direction") == "A01") & (F.col("imbalance_mwh") < 0)
    down = (F.col("direction") == "A02") & (F.col("imbalance_mwh") > 0)
    return F.coalesce(up | down, F.lit(False))


def price_rules() -> dict[str, Column]:
    return {"zone": zone_known(), "timestamp_utc": _at(), "price_eur_mwh": F.col("price_eur_mwh").isNotNull()}


def housing_rules(value: str) -> dict[str, Column]:
    return {
        "kommunkod": F.col("kommunkod").between(*KOMMUNKOD),
        "region_name": F.length(F.trim("region_name")) > 0,
        value: F.col(value) >= 0,
        "raw_quarter_str": F.col("raw_quarter_str").rlike(periods.QUARTER),
    }


def rate_rules() -> dict[str, Column]:
    return {
        "policy_rate_pct": F.col("policy_rate_pct").between(*POLICY_RATE_PCT),
        "raw_date_str": F.col("raw_date_str").rlike(r"^\d{4}-\d{2}-\d{2}$"),
        "effective_date_utc": F.col("effective_date_utc") == periods.day_start(F.col("raw_date_str")),
    }


def rate_series_warning(name: str = "series_name") -> Column:
    # Words that occur in the names of policy-rate series.
    return ~F.lower(F.col(name)).rlike("repo|policy|styrränta|ränta")


def weather_rules() -> dict[str, Column]:
    return {"value": text.locale_double(F.col("value")).isNotNull(), "epoch_ms": F.col("epoch_ms") > 0}


def station_rules() -> dict[str, Column]:
    return {
        "latitude": F.col("latitude").between(-90, 90),
        "longitude": F.col("longitude").between(-180, 180),
        "total_records": F.col("total_records") >= 0,
        "failed_records": (F.col("failed_records") >= 0) & (F.col("failed_records") <= F.col("total_records")),
    }


def outage_rules() -> dict[str, Column]:
    return {"zone": zone_known(), "timestamp_utc": _at(), "outage_mw": F.col("outage_mw").between(*OUTAGE_MW)}


def net_position_rules() -> dict[str, Column]:
    position = F.abs(F.col("scheduled_net_position_mw")) <= NET_POSITION_ABS_MW
    return {"zone": zone_known(), "timestamp_utc": _at(), "scheduled_net_position_mw": position}


def hydro_rules() -> dict[str, Column]:
    year, week = F.col("year"), F.col("week_of_year")
    weeks = F.when(periods.has_53_weeks(year), 53).otherwise(52)
    return {
        "year": year.between(periods.FIRST_YEAR, periods.LAST_YEAR),
        "week_of_year": week.between(1, weeks),
        "reservoir_fill_ratio": F.col("reservoir_fill_ratio").between(0.0, 1.0),
    }


def silver_weather_rules(station_zone: Column) -> dict[str, Column]:
    """``station_zone`` is the zone the station belongs to, NULL if the station is unknown."""
    return {
        "zone": zone_known(),
        "station_id": station_zone.isNotNull(),
        "station_zone": station_zone == F.col("zone"),
        "measurement": F.col("temperature_c").isNotNull() | F.col("wind_speed_ms").isNotNull(),
    }


def silver_market_rules() -> dict[str, Column]:
    fill = F.col("reservoir_fill_ratio")
    return {
        "zone": zone_known(),
        "outage_mw": F.col("outage_mw") >= 0,
        "reservoir_fill_ratio": fill.isNull() | fill.between(0.0, 1.0),
    }


def silver_grid_rules() -> dict[str, Column]:
    load = F.col("load_mw")
    flags = ["is_anomaly", "is_quarantined", "has_imputed_grid"]
    return {
        "zone": zone_known(),
        "timestamp_utc": _at(),
        "load_mw": load.isNull() | (load >= 0),
        **{f: F.col(f).isNotNull() for f in flags},
    }


# --- anomaly flags -------------------------------------------------------------------------


def outside(c: Column, low: float, high: float) -> Column:
    """Outside the closed range; a missing value is not anomalous."""
    return F.coalesce((c < low) | (c > high), F.lit(False))


def load_anomaly(c: str = "load_mw", limits: tuple[float, float] = LOAD_MW) -> dict[str, Column]:
    low, high = limits
    return {"load_below_minimum": F.col(c) < low, "load_above_maximum": F.col(c) > high}


def imbalance_anomaly(c: str = "imbalance_mwh", limit: float = IMBALANCE_ABS_MWH) -> dict[str, Column]:
    return {"imbalance_beyond_limit": F.abs(F.col(c)) > limit}


def price_anomaly(c: str = "price_eur_mwh", limits: tuple[float, float] = PRICE_EUR) -> dict[str, Column]:
    low, high = limits
    return {"price_below_minimum": F.col(c) < low, "price_above_maximum": F.col(c) > high}


def flag_anomalies(df: DataFrame, checks: Mapping[str, Column], flag: str = "is_anomaly") -> DataFrame:
    """Add ``anomaly_reasons`` and the flag."""
    marks = [F.when(F.coalesce(hit, F.lit(False)), F.lit(name)) for name, hit in checks.items()]
    marked = df.withColumn("anomaly_reasons", F.array_compact(F.array(*marks)))
    return marked.withColumn(flag, F.size("anomaly_reasons") > 0)


def spread_flag(df: DataFrame, keys: Sequence[str] = ("zone", "timestamp_utc"), flag: str = "is_anomaly") -> DataFrame:
    """Flag every row that shares its key with a flagged one.

    The flagged keys are made distinct before the join, so many copies of one key are never
    gathered; a hot key on the left is split by the adaptive skew join.
    """
    hit = df.where(F.col(flag)).select(*keys).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(hit, list(keys), "left")
    return joined.withColumn(flag, F.coalesce("_hit", F.lit(False))).select(*df.columns)


def quarantine(df: DataFrame, flag: str = "is_quarantined") -> DataFrame:
    """Anomalous rows and rows with neither load nor imbalance; to be applied after gap filling."""
    empty = F.col("load_mw").isNull() & F.col("imbalance_mwh").isNull()
    return df.withColumn(flag, F.coalesce("is_anomaly", F.lit(False)) | empty)

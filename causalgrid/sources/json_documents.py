"""JSON answers of statistics, rate and weather services, as typed rows with reject reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causalgrid.functions import periods, text
from causalgrid.operators import validate

CUBE = "data array<struct<key:array<string>,values:array<string>>>"
CUBE_META = "variables array<struct<id:string,values:array<string>,valueTexts:array<string>>>"
_OBS = "array<struct<date:string,value:string>>"
RATES = f"groups array<struct<seriesId:string,observations:{_OBS}>>, observations {_OBS}"
WEATHER = (
    "station struct<key:string,name:string,latitude:double,longitude:double>, parameter struct<key:string,name:string>, "
    "value array<struct<date:string,value:string,quality:string>>"
)

# Marks for cells without a number.
SUPPRESSED = ".."
NO_RATE = ("NA", "N/A", "", ".", "..")
# Parameter numbers of the weather service.
TEMPERATURE, WIND = 1, 4


def _others(df: DataFrame, payload: str) -> list[str]:
    return [c for c in df.columns if c != payload]


def cube_rows(payloads: DataFrame, value: str, payload: str = "payload") -> DataFrame:
    """Every cell of a statistics cube: accepted ones typed, others with ``reject_reason``."""
    cells = payloads.select(*_others(payloads, payload), F.inline(F.from_json(payload, CUBE)["data"]))
    code, quarter, raw = F.try_element_at("key", F.lit(1)), F.try_element_at("key", F.lit(2)), F.try_element_at("values", F.lit(1))
    kommunkod, number = text.plain_code(code), text.locale_double(raw)
    period = periods.quarter_start(quarter, check_year=False)
    short = (F.coalesce(F.size("key"), F.lit(0)) < 2) | (F.coalesce(F.size("values"), F.lit(0)) < 1)
    reason = (
        F.when(short, "short_row")
        .when(raw == SUPPRESSED, "suppressed")
        .when(kommunkod.isNull(), "bad_code")
        .when(number.isNull(), "bad_value")
        .when(period.isNull(), "bad_quarter")
    )
    return cells.select(
        *_others(payloads, payload),
        code.alias("region_code"),
        quarter.alias("raw_quarter_str"),
        period.alias("period_utc"),
        kommunkod.alias("kommunkod"),
        number.alias(value),
        reason.alias("reject_reason"),
    )


def with_region_name(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Name per region code. A numeric suffix goes from every name, so unknown ones read ``Okänd``."""
    named = rows.join(labels.select("region_code", F.col("region_name").alias("_name")), "region_code", "left")
    unknown = F.concat(F.lit("Okänd ("), F.regexp_replace("region_code", "^0+(?=.)", ""), F.lit(")"))
    return named.select(*rows.columns, text.strip_code_suffix(F.coalesce("_name", unknown)).alias("region_name"))


def cube_quarters(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Quarters a cube offers."""
    variables = payloads.select(F.inline(F.from_json(payload, CUBE_META)["variables"]))
    offered = variables.where(F.col("id") == "Tid").select(F.explode("values").alias("raw_quarter_str"))
    return offered.where(F.col("raw_quarter_str").rlike(periods.QUARTER)).distinct()


def cube_regions(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Code and name of the regions of a cube."""
    variables = payloads.select(F.inline(F.from_json(payload, CUBE_META)["variables"]))
    regions = variables.where(F.col("id") == "Region")
    pairs = regions.select(F.inline(F.arrays_zip(F.col("values").alias("region_code"), F.col("valueTexts").alias("region_name"))))
    pairs = pairs.where(F.col("region_code").isNotNull() & F.col("region_name").isNotNull())
    return pairs.groupBy("region_code").agg(F.max(text.strip_code_suffix(F.col("region_name"))).alias("region_name"))


def rate_records(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Every observation of a rate series in any of three shapes: typed, or with ``reject_reason``; a document without any has one row."""
    wrapped, bare = F.from_json(payload, RATES), F.from_json(payload, _OBS)
    grouped = F.flatten(F.transform(wrapped["groups"], lambda g: F.coalesce(g["observations"], F.array().cast(_OBS))))
    found = F.coalesce(F.when(F.size(grouped) > 0, grouped), wrapped["observations"], bare)
    others = _others(payloads, payload)
    empty = (F.coalesce(F.size(found), F.lit(0)) <= 0).alias("_empty")
    rows = payloads.select(*others, empty, F.inline_outer(found))
    shown = F.upper(F.trim(F.coalesce("value", F.lit("NA"))))
    rate = text.locale_double(F.col("value"))
    reason = (
        F.when(F.col("_empty"), "unreadable")
        .when(F.length(F.coalesce("date", F.lit(""))) == 0, "no_date")
        .when(shown.isin(*NO_RATE), "missing")
        .when(rate.isNull(), "bad_value")
    )
    return rows.select(
        *others,
        F.col("date").alias("raw_date_str"),
        periods.day_start(F.col("date")).alias("effective_date_utc"),
        rate.alias("policy_rate_pct"),
        F.col("value").alias("raw_value"),
        reason.alias("reject_reason"),
    )


def rate_rows(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """The observations that can be read; ``rate_records`` has the others too."""
    return rate_records(payloads, payload).where("reject_reason is null").drop("raw_value", "reject_reason")


def weather_rows(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Observations of one station and parameter per document.

    Needs ``zone``, ``station_id`` and ``parameter_id`` beside the payload; ``reject_reason`` is
    set where value or time cannot be read.
    """
    others = _others(payloads, payload)
    obs = payloads.select(*others, F.inline(F.from_json(payload, WEATHER)["value"]))
    value = text.locale_double(F.col("value"))
    at: Column = F.col("date").try_cast("long")
    temperature = F.col("parameter_id") == TEMPERATURE
    t, w = F.when(temperature, value), F.when(~temperature, value)
    anomaly = validate.outside(t, *validate.TEMPERATURE_C) | validate.outside(w, *validate.WIND_MS)
    reason = F.when(value.isNull(), "bad_value").when(at.isNull() | (at <= 0), "bad_time")
    return obs.select(
        *others,
        F.timestamp_millis(at).alias("timestamp_utc"),
        t.alias("temperature_c"),
        w.alias("wind_speed_ms"),
        F.coalesce("quality", F.lit("G")).alias("quality_flag"),
        anomaly.alias("is_anomaly"),
        reason.alias("reject_reason"),
    )


def station_summary(payloads: DataFrame, rows: DataFrame, payload: str = "payload") -> DataFrame:
    """Position of each station and how many of its records failed."""
    parsed = F.from_json(payload, WEATHER)
    where = payloads.groupBy("station_id").agg(
        F.max(parsed["station"]["latitude"]).alias("latitude"), F.max(parsed["station"]["longitude"]).alias("longitude")
    )
    counts = rows.groupBy("station_id").agg(
        F.count("*").alias("total_records"), F.count("reject_reason").alias("failed_records")
    )
    return where.join(counts, "station_id", "left")

"""Stored tables: dimensions, aligned and feature tables, and the plan of a backfill."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from causalgrid.operators import dims, validate


def read_mapping(spark: SparkSession, path: str, default: DataFrame | None = None) -> DataFrame:
    """``kommunkod, bidding_zone`` from CSV, known zones only, over the default mapping."""
    raw = spark.read.csv(path, header=True)
    validate.require_columns(raw, ["kommunkod", "bidding_zone"], "mapping")
    rows = raw.select(F.trim("kommunkod").try_cast("int").alias("kommunkod"), F.trim("bidding_zone").alias("bidding_zone"))
    known = rows.where(F.col("kommunkod").isNotNull() & F.col("bidding_zone").isin(*validate.ZONES))
    single = known.groupBy("kommunkod").agg(F.max("bidding_zone").alias("bidding_zone"))
    return dims.overridden(dims.kommuner(spark) if default is None else default, single, "kommunkod")


def read_table(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Parquet, or CSV with a header when the path says so; CSV needs a schema, or its columns are strings."""
    if path.endswith((".csv", ".csv.gz")):
        return spark.read.csv(path, header=True, schema=schema)
    return spark.read.parquet(path)


def read_gold(spark: SparkSession, path: str, zones: Sequence[str] | None = None) -> DataFrame:
    """The feature table; other zones' folders are not even listed for reading."""
    df = spark.read.parquet(path)
    validate.require_columns(df, ["zone", "timestamp_utc", "imbalance_mwh", "feature_ready"], "feature table")
    return df.where(F.col("zone").isin(*zones)) if zones else df


def backfill_plan(spark: SparkSession, start: datetime, end: datetime, days: int = 365) -> DataFrame:
    """Half-open stretches of at most ``days`` that cover ``[start, end)``."""
    one = spark.range(1).select(F.lit(start).cast("timestamp").alias("start"), F.lit(end).cast("timestamp").alias("end"))
    return stretches(one, F.col("start"), F.col("end"), days)


def stretches(df: DataFrame, start: Column, end: Column, days: int = 365) -> DataFrame:
    """Per row: the stretches that cover ``[start, end)``, as ``window_start`` and ``window_end``."""
    step = F.expr(f"INTERVAL {days} DAYS")
    placed = df.withColumn("_s", start).withColumn("_e", end).where("_s < _e")
    spelled = placed.withColumn("window_start", F.explode(F.sequence("_s", "_e", step))).where("window_start < _e")
    return spelled.withColumn("window_end", F.least(F.col("window_start") + step, F.col("_e"))).drop("_s", "_e")

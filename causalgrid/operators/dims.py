"""Small fixed dimensions. Their size is that of the tables in this file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Municipality codes per bidding zone; any other code is unmapped until supplied.
KOMMUN_BY_ZONE = {
    "SE1": (2505, 2506, 2510, 2513, 2514, 2518, 2521, 2523, 2560, 2580, 2581, 2582, 2583, 2584),
    "SE2": (2260, 2262, 2280, 2281, 2282, 2283, 2284, 2313, 2321, 2326, 2380, 2401, 2403, 2480, 2481, 2482, 2490),
    "SE3": (
        114, 115, 117, 120, 123, 125, 126, 127, 128, 136, 138, 139, 140, 160, 162, 163, 180, 181, 182, 183,
        184, 186, 187, 188, 191, 192, 330, 1480, 1482, 1485, 2031, 2034, 2039, 2061, 2062, 2080, 2081, 2082, 2084,
    ),
    "SE4": (
        1080, 1081, 1082, 1083, 1230, 1231, 1233, 1256, 1257, 1260, 1261, 1262, 1263, 1264, 1265, 1266, 1267, 1270,
        1272, 1273, 1275, 1276, 1277, 1278, 1280, 1281, 1282, 1283, 1284, 1285, 1286, 1287, 1290, 1291, 1292, 1293,
    ),
}

# Weather station per zone.
STATION_ZONE = {140480: "SE1", 86340: "SE2", 98210: "SE3", 62040: "SE4"}

# Area codes of the bidding zones in market documents.
AREA_CODE = {
    "10Y1001A1001A44P": "SE1",
    "10Y1001A1001A45N": "SE2",
    "10Y1001A1001A46L": "SE3",
    "10Y1001A1001A47J": "SE4",
}

# Production units, their zone and installed MW.
UNITS = {
    "FORSMARK_1": ("SE3", 1008.0),
    "FORSMARK_2": ("SE3", 1120.0),
    "FORSMARK_3": ("SE3", 1170.0),
    "RINGHALS_3": ("SE3", 1063.0),
    "RINGHALS_4": ("SE3", 1130.0),
    "STENUNGSUND_B3": ("SE3", 630.0),
    "KARLSHAMN_G1": ("SE4", 200.0),
    "KARLSHAMN_G2": ("SE4", 200.0),
    "KARLSHAMN_G3": ("SE4", 200.0),
}


def _inline(spark: SparkSession, columns: Sequence[str], rows) -> DataFrame:
    """A VALUES table: the optimizer knows its exact size and may broadcast it."""
    body = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v!r}D" if isinstance(v, float) else str(v) for v in row) + ")" for row in rows)
    return spark.sql(f"select * from values {body} as t({', '.join(columns)})")


def kommuner(spark: SparkSession) -> DataFrame:
    return _inline(spark, ["kommunkod", "bidding_zone"], [(k, z) for z, ks in KOMMUN_BY_ZONE.items() for k in ks])


def stations(spark: SparkSession) -> DataFrame:
    return _inline(spark, ["station_id", "station_zone"], list(STATION_ZONE.items()))


def area_codes(spark: SparkSession) -> DataFrame:
    return _inline(spark, ["area_code", "zone"], list(AREA_CODE.items()))


def units(spark: SparkSession) -> DataFrame:
    return _inline(spark, ["unit", "zone", "installed_mw"], [(u, z, mw) for u, (z, mw) in UNITS.items()])


def overridden(default: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """``extra`` replaces and extends ``default``."""
    return default.join(extra, key, "left_anti").unionByName(extra.select(*default.columns))


def with_zone(df: DataFrame, mapping: DataFrame, key: str = "kommunkod") -> DataFrame:
    """Add ``bidding_zone``; NULL for codes without a zone."""
    return df.join(mapping.select(key, "bidding_zone"), key, "left").select(*df.columns, "bidding_zone")


def with_label(df: DataFrame, names: DataFrame, key: str, label: str) -> DataFrame:
    """Add the name of a code; codes without one are called ``Okänd (code)``."""
    unknown = F.concat(F.lit("Okänd ("), F.col(key).cast("string"), F.lit(")"))
    named = df.join(names.select(key, F.col(label).alias("_label")), key, "left")
    return named.select(*df.columns, F.coalesce("_label", unknown).alias(label))


def with_station_zone(df: DataFrame, registry: DataFrame) -> DataFrame:
    return df.join(registry, "station_id", "left").select(*df.columns, "station_zone")


def foreign_stations(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of unknown stations and of stations that belong to another zone."""
    home = registry.select("station_id", F.col("station_zone").alias("zone"))
    return df.join(home, ["station_id", "zone"], "left_anti")


def strict_stations(df: DataFrame, registry: DataFrame) -> DataFrame:
    """The rows themselves, or an error naming the first foreign station met."""
    known = with_station_zone(df, registry)
    foreign = F.col("station_zone").isNull() | (F.col("station_zone") != F.col("zone"))
    stop = F.raise_error(F.concat(F.lit("station "), F.col("station_id").cast("string"), F.lit(" does not belong to zone "), F.col("zone")))
    return known.where(F.when(foreign, stop.cast("boolean")).otherwise(F.lit(True))).select(*df.columns)

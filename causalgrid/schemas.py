"""Column contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType


def _schema(**columns) -> StructType:
    return StructType([StructField(n, t) for n, t in columns.items()])


_TS, _S, _D, _B, _I = TimestampType(), StringType(), DoubleType(), BooleanType(), IntegerType()

LOAD = _schema(zone=_S, timestamp_utc=_TS, load_mw=_D, resolution_minutes=_I, is_anomaly=_B)
IMBALANCE = _schema(zone=_S, timestamp_utc=_TS, imbalance_mwh=_D, direction=_S, is_anomaly=_B)
PRICE = _schema(zone=_S, timestamp_utc=_TS, price_eur_mwh=_D, is_anomaly=_B)
WEATHER = _schema(
    timestamp_utc=_TS, zone=_S, station_id=_I, temperature_c=_D, wind_speed_ms=_D, quality_flag=_S, is_anomaly=_B
)
SILVER = _schema(
    timestamp_utc=_TS,
    zone=_S,
    load_mw=_D,
    imbalance_mwh=_D,
    price_eur_mwh=_D,
    smahus_construction_index=_D,
    smahus_price_index=_D,
    riksbank_policy_rate_pct=_D,
    is_anomaly=_B,
    is_quarantined=_B,
    has_imputed_grid=_B,
)


def conform(df: DataFrame, schema: StructType, keep_others: bool = True) -> DataFrame:
    """Every column of the schema in its type: missing numbers NULL, missing flags false."""

    def one(field: StructField):
        if field.name not in df.columns:
            empty = F.lit(False) if isinstance(field.dataType, BooleanType) else F.lit(None)
            return empty.cast(field.dataType).alias(field.name)
        c = F.col(field.name).cast(field.dataType)
        return (F.coalesce(c, F.lit(False)) if isinstance(field.dataType, BooleanType) else c).alias(field.name)

    others = [c for c in df.columns if c not in schema.names] if keep_others else []
    return df.select(*[one(f) for f in schema], *others)

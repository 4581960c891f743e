"""Market documents: load, imbalance and day-ahead price points."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from causalgrid.sources.payloads import is_error_document, name_parts


@dataclass(frozen=True)
class Kind:
    document: str
    value_tag: str
    value: str


# Document types and the tag that holds the value.
LOAD = Kind("A65", "quantity", "load_mw")
IMBALANCE = Kind("A86", "quantity", "imbalance_mwh")
PRICE = Kind("A44", "price.amount", "price_eur_mwh")

# Minutes per resolution code; any other code counts as an hour.
RESOLUTION_MINUTES = {"PT15M": 15, "PT30M": 30, "PT60M": 60, "PT1H": 60}
# Fixed value: direction whose quantities are negative.
DOWN = "A02"


def series_schema(kind: Kind) -> str:
    point = f"struct<position:string,`{kind.value_tag}`:string>"
    period = f"struct<timeInterval:struct<start:string,end:string>,resolution:string,Point:array<{point}>>"
    return f"`flowDirection.direction` string, Period array<{period}>"


def read_series(spark: SparkSession, path: str, kind: Kind) -> DataFrame:
    """One row per TimeSeries of the files under ``path``; large files are split between them."""
    reader = spark.read.format("xml").option("rowTag", "TimeSeries").schema(series_schema(kind))
    raw = reader.load(path)
    named = [c for c in raw.columns if c not in ("flowDirection.direction", "Period")]
    parts = {} if "zone" in named else {"zone": name_parts(F.col("_metadata.file_name"))["zone"]}
    return raw.withColumns(parts)


def parse_series(payloads: DataFrame, kind: Kind, payload: str = "payload") -> DataFrame:
    """One row per TimeSeries of the documents in a column.

    A document without a readable series has one row, with the reason in ``document_reason``, so that ``point_rows`` can
    account for it.
    """
    schema = f"TimeSeries array<struct<{series_schema(kind).replace(' string', ':string').replace('Period array', 'Period:array')}>>"
    parsed = F.from_xml(F.col(payload), schema, {"mode": "PERMISSIVE"})["TimeSeries"]
    empty = F.coalesce(F.size(parsed), F.lit(0)) <= 0
    reason = F.when(F.col(payload).isNull(), "no_payload").when(empty & is_error_document(F.col(payload)), "error_document").when(empty, "unreadable")
    others = [c for c in payloads.columns if c != payload]
    return payloads.select(*others, reason.alias("document_reason"), F.inline_outer(parsed))


def period_start(raw: Column) -> Column:
    """With or without seconds; zone-less times are UTC."""
    s = F.trim(raw)
    forms = ["yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss"]
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in forms])


def resolution_minutes(raw: Column) -> Column:
    code = F.upper(F.coalesce(raw, F.lit("PT60M")))
    out = None
    for name, minutes in RESOLUTION_MINUTES.items():
        out = F.when(code == name, minutes) if out is None else out.when(code == name, minutes)
    return out.otherwise(60)


def point_rows(series: DataFrame, kind: Kind) -> DataFrame:
    """Every point of the first period of each series: typed, or with ``reject_reason``.

    A document or a series that gives no points at all has one row; ``reject_level`` says of what. Rows of level ``point`` and rows without a
    reason add up to the points of the input. Raw spellings stay beside the typed values.
    """
    inner = ("flowDirection.direction", "Period", "document_reason")
    others = [c for c in series.columns if c not in inner]
    document = F.col("document_reason") if "document_reason" in series.columns else F.lit(None).cast("string")
    period = F.try_element_at("Period", F.lit(1))
    spelled = series.select(
        *others,
        F.col("`flowDirection.direction`").alias("direction"),
        document.alias("_document"),
        period.isNull().alias("_no_period"),
        period["timeInterval"]["start"].alias("raw_start"),
        resolution_minutes(period["resolution"]).alias("resolution_minutes"),
        F.explode_outer(period["Point"]).alias("_point"),
    )
    raw_position, raw_value = F.col("_point.position"), F.col(f"_point.`{kind.value_tag}`")
    start, position = period_start(F.col("raw_start")), F.trim(raw_position).try_cast("int")
    value = F.trim(raw_value).try_cast("double")
    if kind is IMBALANCE:
        value = F.when(F.col("direction") == DOWN, -F.abs(value)).otherwise(F.abs(value))
    at = F.timestamp_add("MINUTE", F.col("resolution_minutes") * (position - 1), start)
    whole = F.col("_document").isNotNull() | F.col("_no_period") | F.col("_point").isNull()
    reason = (
        F.coalesce("_document", F.when(F.col("_no_period"), "no_period"), F.when(F.col("_point").isNull(), "no_points"), F.when(start.isNull(), "no_start"))
    )
    reason = F.coalesce(reason, F.when(at.isNull(), "bad_position"), F.when(value.isNull() | F.isnan(value), "bad_value"))
    level = F.when(F.col("_document").isNotNull(), "document").when(whole, "series").otherwise("point")
    extra = {LOAD: ["resolution_minutes"], IMBALANCE: ["direction"]}.get(kind, [])
    return spelled.select(
        *others, at.alias("timestamp_utc"), value.alias(kind.value), *extra,
        "raw_start", raw_position.alias("raw_position"), raw_value.alias("raw_value"), level.alias("reject_level"), reason.alias("reject_reason"),
    ).withColumn("reject_level", F.when(F.col("reject_reason").isNotNull(), F.col("reject_level")))


REJECT_COLUMNS = ("raw_start", "raw_position", "raw_value", "reject_level", "reject_reason")


def points(series: DataFrame, kind: Kind) -> DataFrame:
    """(zone, timestamp, value) per readable point; what cannot be read is in ``rejects``."""
    return accepted(point_rows(series, kind))


def accepted(rows: DataFrame) -> DataFrame:
    """Of ``point_rows``: the typed points."""
    return rows.where("reject_reason is null").drop(*REJECT_COLUMNS)


def rejects(series: DataFrame, kind: Kind) -> DataFrame:
    """What ``points`` leaves out, with the reason and the raw spelling."""
    return point_rows(series, kind).where("reject_reason is not null")


def counted(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``rows`` with counts of accepted points, rejected points, series and documents, known once they have been read."""
    seen = Observation(name)
    level = F.col("reject_level")
    counts = [F.count_if(F.col("reject_reason").isNull()).alias("accepted")]
    return rows.observe(seen, *counts, *[F.count_if(level == x).alias(f"rejected_{x}") for x in ("point", "series", "document")]), seen

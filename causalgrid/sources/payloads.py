"""Raw files to one row per document: name, ingest date and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from causalgrid.functions import text

# Fixed value: {document}_{zone}_{from}_{to}_{ingested}.xml.gz
FILE_NAME = r"^([A-Z]\d{2})_([A-Z]+\d)_([0-9TZ:-]+)_([0-9TZ:-]+)_([0-9TZ:-]+)\.xml(?:\.gz)?$"
NAME_PARTS = ("document", "zone", "period_from", "period_to", "ingested")


def name_parts(name: Column) -> dict[str, Column]:
    return {part: F.regexp_extract(name, FILE_NAME, i + 1) for i, part in enumerate(NAME_PARTS)}


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files, gzip or not. One document is one request, some kilobytes to megabytes."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("payload"))


def read_bytes(spark: SparkSession, path: str, declared: str = "utf-8") -> DataFrame:
    """Files of uncertain encoding; ``payload`` is NULL where the text is damaged."""
    files = spark.read.format("binaryFile").load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name")
    return files.select(name, text.decode_bytes(F.col("content"), declared).alias("payload"))


# Fixed value: an element "Reason" with an element "code" in it, under any namespace prefix.
REASON_WITH_CODE = (
    r"<(?:[\w.-]+:)?Reason\b[^>]*>[^<]*+(?:<(?!/?(?:[\w.-]+:)?(?:Reason|code)\b)[^<]*+)*+<(?:[\w.-]+:)?code\b"
)


def is_error_document(payload: Column, prefix: int | None = None) -> Column:
    """An acknowledgement that says why there is no data, wherever in the document it says so.

    With ``prefix`` the word "code" has to be among so many first characters and "Reason" anywhere, as
    older archives were sorted.
    """
    if prefix is not None:
        return F.contains(payload, F.lit("Reason")) & F.contains(F.substring(payload, 1, prefix), F.lit("code"))
    return payload.rlike(REASON_WITH_CODE)


def split_errors(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    flag = F.coalesce(is_error_document(F.col("payload")), F.lit(False))
    return payloads.where(~flag), payloads.where(flag)

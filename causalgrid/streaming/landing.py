"""Incremental landing: new files into the aligned folders, restated hours included.

Sources are fetched in overlapping windows and corrected later, by days or by years. A batch is
merged with the stored months it touches, the last record of an hour winning, and only those
months are replaced. That settles repeats and late records of any age, and a batch that is run
again gives the same folders; stream state behind a watermark would drop what comes late.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from causalgrid.operators import regular
from causalgrid.session import materialize
from causalgrid.sources import market_xml, payloads, sinks

KEYS = ("zone", "timestamp_utc")


def read_points(spark: SparkSession, path: str, schema: StructType, glob: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_documents(spark: SparkSession, path: str, glob: str = "*", files_per_batch: int | None = None) -> DataFrame:
    """A stream of whole raw documents, gzip or not: ``file_name, file_path, payload``. New files are found in new folders too."""
    reader = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.load(path)
    return raw.select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("payload"))


def merge_batch(batch: DataFrame, path: str, order: Sequence[str]) -> None:
    """Replace the (zone, year, month) folders the batch touches by old and new rows together."""
    spark = batch.sparkSession
    new = materialize(sinks.with_calendar_keys(batch), "landing-batch")
    merged = new
    try:
        stored = spark.read.schema(new.schema).parquet(path)
        merged = stored.where(touched_folders(new)).unionByName(new)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    kept = regular.keep_last(merged, KEYS, order)
    # the folders are read and replaced: go through a table of its own
    sinks.write_silver(materialize(kept.drop("year", "month"), "landing-merged"), path)


def touched_folders(new: DataFrame) -> Column:
    """Of the folders: those that ``new`` has rows for, as literals, so that no other folder is read.

    A batch touches few of them: as many as it has months and zones.
    """
    folders = new.select(*sinks.MONTHLY).distinct().collect()
    each = [reduce(and_, [F.col(c).eqNullSafe(F.lit(f[c])) for c in sinks.MONTHLY]) for f in folders]
    return reduce(or_, each, F.lit(False))


def document_points(documents: DataFrame, kind: market_xml.Kind) -> DataFrame:
    """All points of raw documents, rejected ones too, with what their names say: zone and time of ingestion.

    Points of a document that names no zone are rejected.
    """
    name = payloads.name_parts(F.col("file_name"))
    named = {c: F.nullif(F.coalesce(F.col(c), name[c]) if c in documents.columns else name[c], F.lit("")) for c in ("zone", "ingested")}
    rows = market_xml.point_rows(market_xml.parse_series(documents.withColumns(named), kind), kind)
    homeless = F.col("reject_reason").isNull() & F.col("zone").isNull()
    return rows.withColumns(
        {
            "reject_level": F.when(homeless, "point").otherwise(F.col("reject_level")),
            "reject_reason": F.when(homeless, "no_zone").otherwise(F.col("reject_reason")),
        }
    )


#: What identifies a reject: the document, what it held, and where.
DOCUMENT = ("file_name", "content_sha256")
REJECT = ("zone", "ingested", *DOCUMENT, *market_xml.REJECT_COLUMNS)


def merge_documents(batch: DataFrame, kind: market_xml.Kind, path: str, rejects_path: str) -> None:
    """Parse a batch of documents once; its points go to the aligned folders, what could not be read to the reject table.

    Points are merged by hour, rejects by document, so a batch or a drop that comes again changes nothing.
    """
    documents = batch.withColumn("content_sha256", F.sha2("payload", 256)).dropDuplicates(list(DOCUMENT))
    rows = materialize(document_points(documents, kind), "landing-documents")
    merge_batch(market_xml.accepted(rows).drop("file_path"), path, ["ingested", *DOCUMENT])
    bad = rows.where("reject_reason is not null").select(*REJECT)
    merge_rejects(bad.withColumn("ingest_date", F.coalesce(F.substring("ingested", 1, 10), F.lit("unknown"))), rejects_path)


def merge_rejects(new: DataFrame, path: str) -> None:
    """Replace the ingest days that rejects touch: what other documents left there stays, a document's own rows are new."""
    spark = new.sparkSession
    new = materialize(new, "landing-rejects")
    days = [r.ingest_date for r in new.select("ingest_date").distinct().collect()]
    if not days:
        return
    merged = new
    try:
        there = spark.read.schema(new.schema).parquet(path).where(F.col("ingest_date").isin(*days))
        merged = there.join(new.select(*DOCUMENT).distinct(), list(DOCUMENT), "left_anti").unionByName(new)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    # the folders are read and replaced: go through a table of its own
    once = materialize(merged, "landing-rejects-merged")
    once.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date").parquet(path)


def land_documents(documents: DataFrame, kind: market_xml.Kind, path: str, rejects_path: str, checkpoint: str) -> StreamingQuery:
    """Land all raw documents that are there now and stop; start again to go on from there."""
    writer = documents.writeStream.foreachBatch(lambda batch, _: merge_documents(batch, kind, path, rejects_path))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def land(points: DataFrame, path: str, checkpoint: str, order: Sequence[str]) -> StreamingQuery:
    """Land everything available now and stop; start again to go on from there."""
    writer = points.writeStream.foreachBatch(lambda batch, _: merge_batch(batch, path, order))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

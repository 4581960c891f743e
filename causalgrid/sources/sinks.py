"""Writers. Every one can be run again over the same window without doubling anything."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MONTHLY, YEARLY = ("zone", "year", "month"), ("zone", "year")


#: Bytes of a file that one row of the raw table holds; a longer file is several rows.
PART_BYTES = 1 << 20


def land_raw(spark: SparkSession, source_path: str, table_path: str, source: str, ingest_date: str) -> None:
    """Files as they are, hashed, before anything is parsed; a file known by name and content is not stored again.

    A row holds at most ``PART_BYTES`` of a file, numbered by ``part`` from 0; empty files are not read. What is new is
    settled on names and hashes. The new paths, fewer than the listing of the source that the driver has, are sent to every
    executor, so contents are read by one task each and never shuffled.
    """
    files = spark.read.format("binaryFile").load(source_path)
    named = files.select(
        "path",
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        "content",
        F.sha2("content", 256).alias("content_sha256"),
        F.lit(source).alias("source"),
        F.lit(ingest_date).cast("date").alias("ingest_date"),
    )
    key = ["file_name", "content_sha256"]
    new = named.groupBy(*key).agg(F.min("path").alias("path"))
    try:
        known = spark.read.parquet(table_path).where(F.col("source") == source).select(*key)
        new = new.join(known, key, "left_anti")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    rows = named.join(F.broadcast(new.select("path")), "path", "left_semi").drop("path")
    last = F.ceil(F.octet_length("content") / PART_BYTES).cast("int") - 1
    parts = rows.withColumn("part", F.explode(F.sequence(F.lit(0), last)))
    content = F.substring("content", F.col("part") * PART_BYTES + 1, F.lit(PART_BYTES))
    out = parts.select("file_name", "part", content.alias("content"), "content_sha256", "source", "ingest_date")
    writer = out.write.mode("append").option("compression", "gzip")
    # sizes are looked at every few rows, as rows are large, and a reader takes a row group at a time
    writer = writer.option("parquet.block.size", 16 << 20).option("parquet.page.size.row.check.min", 4).option("parquet.page.size.row.check.max", 16)
    writer.partitionBy("source", "ingest_date").parquet(table_path)


def raw_lines(landed: DataFrame) -> DataFrame:
    """``source, ingest_date, file_name, content_sha256, line`` of stored files: their lines as bytes, those that parts cut put together.

    Only what stands before the first and after the last line end of a part is shuffled. What follows a file's last line end
    is a line, if there is any.
    """
    file = ["source", "ingest_date", "file_name", "content_sha256"]
    # one character for each byte, as a cut may lie within a letter
    pieces = landed.select(*file, "part", F.split(F.decode("content", "ISO-8859-1"), "\n").alias("pieces"))
    n = F.size("pieces")
    whole = pieces.select(*file, F.explode(F.slice("pieces", F.lit(2), F.greatest(n - 2, F.lit(0)))).alias("piece"))
    first = F.struct(F.lit(0).alias("at"), F.get("pieces", F.lit(0)).alias("piece"))
    last = F.struct(F.lit(1).alias("at"), F.get("pieces", n - 1).alias("piece"))
    cut = pieces.select(*file, "part", F.inline(F.when(n > 1, F.array(first, last)).otherwise(F.array(first))))
    # after a part's first piece a new line begins
    cut = cut.withColumn("number", F.sum("at").over(Window.partitionBy(*file).orderBy("part", "at")))
    pieces_of = F.transform(F.array_sort(F.collect_list(F.struct("part", "at", "piece"))), lambda x: x["piece"])
    joined = cut.groupBy(*file, "number").agg(F.concat_ws("", pieces_of).alias("piece"), F.max("number").over(Window.partitionBy(*file)).alias("last"))
    ended = joined.where("number < last or piece <> ''").select(*file, "piece")
    return whole.unionByName(ended).select(*file, F.encode("piece", "ISO-8859-1").alias("line"))


def write_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def with_calendar_keys(df: DataFrame, ts: str = "timestamp_utc") -> DataFrame:
    return df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))


def write_silver(df: DataFrame, path: str, by: Sequence[str] = MONTHLY) -> None:
    """Replace the touched (zone, year, month) folders and no others.

    Rows are brought together by folder, which holds at most a month of hours per zone.
    """
    out = with_calendar_keys(df).repartition(*by).sortWithinPartitions(*by, "timestamp_utc")
    if "month" not in by:
        out = out.drop("month")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_gold(df: DataFrame, path: str, by_zone: bool = True) -> None:
    """By zone or flat. A zone is spread over one task per year, so a large one makes several files."""
    out = df.withColumn("_year", F.year("timestamp_utc")).repartition("zone", "_year").drop("_year")
    out = out.sortWithinPartitions("zone", "timestamp_utc")
    writer = out.write.mode("overwrite")
    (writer.option("partitionOverwriteMode", "dynamic").partitionBy("zone") if by_zone else writer).parquet(path)


def manifest(batch: DataFrame, by: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """One line per source file or zone: whatever of these the batch can tell."""
    has = set(batch.columns)
    stats = [F.count("*").alias("records_total")]
    if "is_valid" in has:
        stats.append(F.count_if(~F.col("is_valid")).alias("records_validation_failed"))
    if "reject_reason" in has:
        stats.append(F.count("reject_reason").alias("records_rejected"))
    if "is_anomaly" in has:
        stats.append(F.count_if(F.col("is_anomaly")).alias("records_anomalous"))
    if "timestamp_utc" in has:
        stats += [F.min("timestamp_utc").alias("period_from"), F.max("timestamp_utc").alias("period_to")]
    return batch.groupBy(*by).agg(*stats, *[c.alias(n) for n, c in measures.items()])


def _of_batch(df: DataFrame, batch: str):
    """A writer that replaces what the batch wrote before and nothing else."""
    out = df.withColumn("batch_id", F.lit(batch)).write.mode("overwrite")
    return out.option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")


def write_json(df: DataFrame, path: str, batch: str) -> None:
    """Manifests, anomaly entries, metric reports: small lines, one file set per batch."""
    _of_batch(df, batch).json(path)


def anomaly_entries(flagged: DataFrame, metric: str, keys: Sequence[str] = ("zone", "timestamp_utc")) -> DataFrame:
    """One entry per anomalous row: the metric, its offending value and the reasons."""
    value = F.col(metric).cast("double").alias("value")
    return flagged.where(F.size("anomaly_reasons") > 0).select(*keys, F.lit(metric).alias("metric"), value, "anomaly_reasons")


def write_rejects(checked: DataFrame, path: str, batch: str) -> None:
    _of_batch(checked.where("not is_valid").drop("is_valid"), batch).parquet(path)

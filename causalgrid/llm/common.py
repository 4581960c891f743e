"""Helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from causalgrid.session import shared_dir

#: ASCII white space; everything else belongs to words.
SPACE = r"[\x20\x09-\x0D]+"
#: Arrow batches handed to Python hold at most so many rows, so that very long texts fit.
BATCH_ROWS = "2000"


def arrow_batches(spark: SparkSession) -> None:
    """Bound the rows and the bytes that one Arrow batch brings into a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use yet, whatever its upper or lower case."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name = f"_{name}"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch with its texts as UTF-8 bytes; a null text is empty."""
    for batch in batches:
        yield batch, [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def doc_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` alone, so that no other column of the input can clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def is_fold(id_col: str, remainder: int, folds: int = 5):
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == remainder

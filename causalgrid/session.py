"""Session settings every plan relies on, and where shared scratch data may live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Bytes that one Arrow batch brings into a Python worker; a longer row is a batch of its own.
BATCH_BYTES = 8 << 20


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps without a zone are UTC everywhere in this library."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds by bytes: a bound by rows alone grows with the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without a setting gets a folder of its own: on a cluster a
    machine-local folder would lose data with the machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="causalgrid-")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is ever reused or overwritten."""
    return f"{shared_dir(spark)}/causalgrid/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there.

    Cuts the lineage, outlives any executor, and tells the optimizer the true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""The streaming query."""

from __future__ import annotations

from pyspark.sql import functions as F

from causalgrid.session import scratch_path
from causalgrid.streaming import landing
from causalgrid.sources import market_xml
from causalgrid.workload.fixtures import with_views
from causalgrid.workload.registry import query
from causalgrid.workload.sources import _UNREADABLE, DAMAGED, READABLE, damaged_documents


@query(
    """select zone, timestamp_utc, arg_max(value, event_id) as value, max(event_id) as event_id, 2024 as year, 1 as month from (
         select 'SE' || (user_id % 4 + 1)::varchar as zone, date_trunc('hour', ts) as timestamp_utc, event_id, value from events) group by 1, 2""",
    doubles="value",
)
def incremental_landing(spark, sf_dir):
    """R-01: the events as a stream of points, landed twice; the last record of an hour wins."""
    path = scratch_path(spark, "landed")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    zone = F.concat(F.lit("SE"), (F.col("user_id") % 4 + 1).cast("string")).alias("zone")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("timestamp_utc")
    for _ in range(2):
        # a stream of its own each time: the second one delivers every record once more
        points = landing.read_points(spark, sf_dir, schema, "events.parquet").select(zone, hour, "event_id", "value")
        landing.land(points, path, scratch_path(spark, "offsets"), ["event_id"]).awaitTermination()
    return spark.read.parquet(path)


@query(
    with_views(
        f"""select 'landed' as kind, zone, count(*) as n, sum(round(load_mw, 2)) as total from ({READABLE}) group by zone
            union all select reason, zone, count(*), null from ({_UNREADABLE}) group by 1, 2""",
        "grid_hourly",
        damaged=DAMAGED,
    ),
    doubles="total",
    digits=1,
)
def raw_incremental_landing(spark, sf_dir):
    """R-01 on raw documents: parsed, checked and landed in the stream; the drop comes twice, the second time as a stream of its own."""
    drop, path, rejects = (scratch_path(spark, x) for x in ("drop", "landed", "rejects"))
    docs = damaged_documents(spark, sf_dir)
    # one document a file, in folders that say zone and day; zones are taken from the path
    docs.repartition("zone", "day").write.partitionBy("zone", "day").text(drop)
    for _ in range(2):
        raw = landing.read_documents(spark, drop, "*.txt", files_per_batch=50)
        zone = F.regexp_extract("file_path", "/zone=([^/]+)/", 1)
        # the writer calls the files of one task alike, so the folders belong to the name
        name = F.regexp_extract("file_path", "([^/]+/[^/]+/[^/]+)$", 1).alias("file_name")
        named = raw.select(name, "file_path", "payload", zone.alias("zone"), F.lit("2024-03-01T00:00Z").alias("ingested"))
        landing.land_documents(named, market_xml.LOAD, path, rejects, scratch_path(spark, "offsets")).awaitTermination()
    landed = spark.read.parquet(path).groupBy(F.lit("landed").alias("kind"), "zone").agg(F.count("*").alias("n"), F.sum("load_mw").alias("total"))
    bad = spark.read.parquet(rejects).groupBy(F.col("reject_reason").alias("kind"), "zone").agg(F.count("*").alias("n"))
    return landed.unionByName(bad.withColumn("total", F.lit(None).cast("double")))

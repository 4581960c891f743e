"""Queries for sinks: written to the shared folder, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from causalgrid.operators import validate
from causalgrid.session import scratch_path
from causalgrid.sources import sinks, tables
from causalgrid.workload import fixtures as fx
from causalgrid.workload.fixtures import table, with_views
from causalgrid.workload.registry import query


@query(
    with_views(
        "select zone, timestamp_utc, load_mw, year(timestamp_utc)::int as year from grid_daily",
        "grid_daily",
    ),
    doubles="load_mw",
    digits=4,
)
def silver_written_twice(spark, sf_dir):
    """K-03: a second write of some years replaces those years and leaves the others alone."""
    path = scratch_path(spark, "silver")
    g = fx.grid_daily(spark, sf_dir).select("zone", "timestamp_utc", "load_mw")
    sinks.write_silver(g, path, sinks.YEARLY)
    sinks.write_silver(g.where(F.year("timestamp_utc") >= 1999), path, sinks.YEARLY)
    return spark.read.parquet(path)


@query(
    with_views(
        "select zone, timestamp_utc, imbalance_mwh, load_mw is not null as feature_ready from grid_hourly where zone in ('SE2', 'SE3')", "grid_hourly"
    ),
    doubles="imbalance_mwh",
)
def gold_read_by_zone(spark, sf_dir):
    """K-04 and S-15: written by zone, read for two zones."""
    path = scratch_path(spark, "gold")
    g = fx.grid_hourly(spark, sf_dir)
    sinks.write_gold(g.select("zone", "timestamp_utc", "imbalance_mwh", F.col("load_mw").isNotNull().alias("feature_ready")), path)
    return tables.read_gold(spark, path, ["SE2", "SE3"])


@query(with_views("select * from net_positions", "net_positions"), doubles="scheduled_net_position_mw")
def market_snapshot(spark, sf_dir):
    """K-02 and S-16: a snapshot overwritten by a newer one."""
    path = scratch_path(spark, "net-positions")
    p = fx.net_positions(spark, sf_dir)
    sinks.write_snapshot(p.where("zone = 'SE1'"), path)
    sinks.write_snapshot(p, path)
    return tables.read_table(spark, path)


@query(with_views("select zone, timestamp_utc, load_mw, imbalance_mwh, price_eur_mwh, is_anomaly from grid_hourly", "grid_hourly"), doubles="load_mw imbalance_mwh price_eur_mwh")
def csv_snapshot(spark, sf_dir):
    """S-14: an aligned table kept as CSV, read with its schema; numbers, flags and times come back as they were."""
    path = f"{scratch_path(spark, 'silver')}.csv"
    g = fx.grid_hourly(spark, sf_dir)
    g.write.option("header", True).csv(path)
    return tables.read_table(spark, path, g.schema)


@query(
    with_views(
        """select zone, count(*) as records_total, count_if(is_anomaly) as records_anomalous, min(timestamp_utc) as period_from, max(timestamp_utc) as period_to,
                  min(price_eur_mwh) as price_min, max(price_eur_mwh) as price_max from grid_hourly group by 1""",
        "grid_hourly",
    ),
    doubles="price_min price_max",
)
def batch_manifest(spark, sf_dir):
    """K-05: what a batch held, per zone, through JSON lines."""
    path = scratch_path(spark, "manifest")
    measures = {"price_min": F.min("price_eur_mwh"), "price_max": F.max("price_eur_mwh")}
    lines = sinks.manifest(fx.grid_hourly(spark, sf_dir), ["zone"], measures)
    for _ in range(2):  # a batch that is run again leaves one set of lines
        sinks.write_json(lines, path, "2024-01-01")
    return spark.read.schema(lines.schema).json(path).drop("batch_id")


@query(
    with_views(
        """select zone, timestamp_utc, 'load_mw' as metric, load_mw as value, concat_ws(',', case when load_mw < 500 then 'load_below_minimum' end, case when load_mw > 20000 then 'load_above_maximum' end) as reasons
           from grid_hourly where load_mw < 500 or load_mw > 20000""",
        "grid_hourly",
    ),
    doubles="value",
)
def anomaly_log(spark, sf_dir):
    """K-06: anomalous points with their values and reasons, through JSON lines."""
    path = scratch_path(spark, "anomalies")
    entries = sinks.anomaly_entries(validate.flag_anomalies(fx.grid_hourly(spark, sf_dir), validate.load_anomaly(limits=(500.0, 20_000.0))), "load_mw")
    for _ in range(2):
        sinks.write_json(entries, path, "2024-01-01")
    back = spark.read.schema(entries.schema).json(path)
    return back.select("zone", "timestamp_utc", "metric", "value", F.concat_ws(",", "anomaly_reasons").alias("reasons"))


@query("select event_id, 'load_mw' as reasons from events where value - 5 < 0")
def reject_table(spark, sf_dir):
    """K-08: rejects are stored with their reason."""
    path = scratch_path(spark, "rejects")
    e = table(spark, sf_dir, "events").select("event_id", (F.col("value") - 5).alias("load_mw"))
    checked = validate.validate(e, {"load_mw": F.col("load_mw") >= 0})
    for _ in range(2):
        sinks.write_rejects(checked, path, "2024-01-01")
    return spark.read.parquet(path).select("event_id", F.concat_ws(",", "failed_rules").alias("reasons"))


@query("select md5(text) as digest, 2 * count(*) as n from documents group by 1")
def raw_landing(spark, sf_dir):
    """K-01: two drops of equal bytes under different names both land; landing again stores nothing twice."""
    source, target = scratch_path(spark, "drop"), scratch_path(spark, "raw")
    docs = table(spark, sf_dir, "documents").select("text")
    # one document per row group of lines would change the text, so each row is kept as one JSON string; a drop has many files of bounded length
    for drop in ("se1", "se2"):
        docs.select(F.to_json(F.struct("text"))).write.option("maxRecordsPerFile", 1_000).text(f"{source}/{drop}")
    for day in ("2024-01-01", "2024-01-02"):
        sinks.land_raw(spark, f"{source}/*", target, "documents", day)
    landed = spark.read.parquet(target).where("source = 'documents'")
    lines = sinks.raw_lines(landed).select(F.decode("line", "UTF-8").alias("line")).where("line <> ''")
    texts = lines.select(F.from_json("line", "text string")["text"].alias("content"))
    return texts.groupBy(F.md5("content").alias("digest")).agg(F.count("*").alias("n"))

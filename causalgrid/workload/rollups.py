"""Queries for aggregations, audits and KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from causalgrid.functions import periods
from causalgrid.operators import audits, dims, metrics, rollup, validate
from causalgrid.workload import fixtures as fx
from causalgrid.workload.fixtures import table, with_views
from causalgrid.workload.joins import (
    EXPANDED,
    GATED,
    OUTAGES_HOURLY,
    WEATHER_SETTLED,
    expanded,
    intervals,
    silver,
)
from causalgrid.workload.registry import query
from causalgrid.workload.series import FILLED, filled_grid

_HOUSING = """
    select make_date(left(raw_quarter_str, 4)::int, (right(raw_quarter_str, 1)::int - 1) * 3 + 1, 1)::timestamp as period_utc, bidding_zone, {agg}
    from housing_kommun join kommun_zone using (kommunkod) where bidding_zone is not null group by 1, 2"""


@query(
    with_views(
        _HOUSING.format(
            agg="sum(smahus_construction_index) as built_sum, avg(smahus_price_index) as price_mean, median(smahus_price_index) as price_median"
        ),
        "housing_kommun",
        "kommun_zone",
    ),
    doubles="built_sum price_mean price_median",
    digits=4,
)
def housing_by_zone(spark, sf_dir):
    """G-01: sum, mean and median over the municipalities of a zone."""
    h, mapping = fx.housing_kommun(spark, sf_dir), fx.kommun_zone(spark, sf_dir)
    h = h.withColumnRenamed("raw_quarter_str", "period_utc")
    out = None
    for value, func, name in (
        ("smahus_construction_index", "sum", "built_sum"),
        ("smahus_price_index", "mean", "price_mean"),
        ("smahus_price_index", "median", "price_median"),
    ):
        one = rollup.to_zone(h, mapping, value, func).withColumnRenamed(value, name)
        out = one if out is None else out.join(one, ["period_utc", "bidding_zone"])
    return out


@query(
    with_views(
        """select zone, timestamp_utc, avg(temperature_c) as temperature_c, avg(wind_speed_ms) as wind_speed_ms, bool_or(is_anomaly) as is_anomaly,
           min(station_id)::int as station_id
           from (select zone, date_trunc('hour', timestamp_utc) as timestamp_utc, temperature_c, wind_speed_ms, is_anomaly, event_id % 7 as station_id
                 from weather_obs) group by 1, 2""",
        "weather_obs",
    ),
    doubles="temperature_c wind_speed_ms",
)
def settle_weather(spark, sf_dir):
    """G-04: several observations of one moment."""
    obs = fx.weather_obs(spark, sf_dir).withColumn("timestamp_utc", F.date_trunc("hour", "timestamp_utc"))
    return rollup.settle_weather(obs.withColumn("station_id", (F.col("event_id") % 7).cast("int")))


@query(
    with_views(
        """select zone, c.name as "column", min(case when c.v is not null then timestamp_utc end) as first_known_utc,
                  100.0 * count(c.v) / count(*) as coverage_pct, 100.0 * count(c.v) / count(*) < 80 as is_low
           from (select zone, timestamp_utc, unnest([struct_pack(name := 'load_mw', v := load_mw), struct_pack(name := 'imbalance_mwh', v := imbalance_mwh)]) as c
                 from grid_hourly) group by 1, 2""",
        "grid_hourly",
    ),
    doubles="coverage_pct",
)
def coverage_audit(spark, sf_dir):
    """G-07: known share per column and zone."""
    return audits.coverage(fx.grid_hourly(spark, sf_dir), ["load_mw", "imbalance_mwh"])


@query(
    with_views(
        """select zone, count_if(timestamp_utc < first) as rows_before_first from (
             select zone, timestamp_utc, min(case when imbalance_mwh > 100 then timestamp_utc end) over (partition by zone) as first from grid_hourly) group by 1""",
        "grid_hourly",
    )
)
def rows_before_first_value(spark, sf_dir):
    """G-07: rows of a zone before its first known value."""
    g = fx.grid_hourly(spark, sf_dir)
    return audits.rows_before_first(g.withColumn("x", F.when(F.col("imbalance_mwh") > 100, 1)), "x")


@query(
    """select coalesce(reason, 'accepted') as outcome, count(*) as n, count(distinct kommunkod) as n_kommunkod, count(distinct quarter) as n_quarter from (
         select o_custkey % 290 as kommunkod, year(o_orderdate)::varchar || 'K' || quarter(o_orderdate)::varchar as quarter, case when o_orderkey % 11 = 0 then 'suppressed' when o_orderkey % 13 = 0 then 'bad_code' when o_totalprice < 5000 then 'negative' end as reason
         from orders) group by 1"""
)
def ingest_report(spark, sf_dir):
    """G-09: accepted and rejected records by reason, with the municipalities and quarters they are about."""
    key = F.col("o_orderkey")
    reason = F.when(key % 11 == 0, "suppressed").when(key % 13 == 0, "bad_code").when(F.col("o_totalprice") < 5000, "negative")
    quarter = F.concat(F.year("o_orderdate").cast("string"), F.lit("K"), F.quarter("o_orderdate").cast("string"))
    parsed = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 290).alias("kommunkod"), quarter.alias("quarter"), reason.alias("reject_reason")
    )
    return audits.ingest_report(parsed, different=["kommunkod", "quarter"])


@query(
    with_views(
        "select kommunkod, count(*) as n_rows from housing_kommun left join kommun_zone using (kommunkod) where bidding_zone is null group by 1",
        "housing_kommun",
        "kommun_zone",
    )
)
def unmapped_codes(spark, sf_dir):
    """G-10."""
    return audits.unmapped_codes(dims.with_zone(fx.housing_kommun(spark, sf_dir), fx.kommun_zone(spark, sf_dir)))


_CHANGES = """
    select effective_date_utc, policy_rate_pct, previous_rate_pct, policy_rate_pct - previous_rate_pct as delta_pct from (
        select *, lag(policy_rate_pct) over (order by effective_date_utc) as previous_rate_pct from policy_rate)
    where previous_rate_pct <> policy_rate_pct"""


@query(with_views(_CHANGES, "policy_rate"), doubles="policy_rate_pct previous_rate_pct delta_pct")
def rate_changes(spark, sf_dir):
    """W-15: dates on which the rate changed."""
    return audits.rate_changes(fx.policy_rate(spark, sf_dir))


@query(
    with_views(f"{_CHANGES} order by effective_date_utc desc limit 5", "policy_rate"), doubles="policy_rate_pct previous_rate_pct delta_pct"
)
def last_rate_changes(spark, sf_dir):
    """T-05."""
    return audits.rate_changes(fx.policy_rate(spark, sf_dir)).orderBy(F.col("effective_date_utc").desc()).limit(5)


@query(
    with_views(
        """select count(*) as n_observations, min(effective_date_utc) as first_utc, max(effective_date_utc) as last_utc,
           min(policy_rate_pct) as min_rate_pct, max(policy_rate_pct) as max_rate_pct from policy_rate""",
        "policy_rate",
    ),
    doubles="min_rate_pct max_rate_pct",
)
def rate_summary(spark, sf_dir):
    """G-11."""
    return audits.rate_summary(fx.policy_rate(spark, sf_dir))


@query(
    with_views(
        """select zone, count(*) as n_rows, 100 * avg((is_anomaly or (load_mw is null and imbalance_mwh is null))::int) as is_quarantined_pct,
                  100 * avg((load_mw is null)::int) as has_imputed_grid_pct,
                  100 * avg((is_anomaly or (load_mw is null and imbalance_mwh is null))::int) > 5 as is_high from grid_hourly group by 1""",
        "grid_hourly",
    ),
    doubles="is_quarantined_pct has_imputed_grid_pct",
)
def quarantine_rates(spark, sf_dir):
    """G-12."""
    g = validate.quarantine(fx.grid_hourly(spark, sf_dir)).withColumn("has_imputed_grid", F.col("load_mw").isNull())
    return audits.flag_rates(g, ["is_quarantined", "has_imputed_grid"])


_OUTAGE_GRID = """
    select g.zone, g.timestamp_utc, coalesce(outage_mw, 0) as outage_mw, coalesce(active_unit_count, 0) as active_unit_count,
           row_number() over (partition by g.zone order by g.timestamp_utc desc) as rk
    from grid_filled g left join outages_hourly o using (zone, timestamp_utc)"""


@query(
    with_views(
        """select *, case when current_outage_mw >= 1000 then 'CRITICAL' when current_outage_mw >= 500 then 'WARNING' else 'NORMAL' end as alert_level
           from (select zone, max(case when rk = 1 then outage_mw end) as current_outage_mw, max(case when rk <= 24 then outage_mw end) as peak_24h_mw,
                 max(case when rk <= 168 then outage_mw end) as peak_168h_mw, max(case when rk = 1 then active_unit_count end) as active_units
                 from outage_grid group by zone)""",
        "grid_hourly",
        "outage_events",
        **FILLED,
        expanded=EXPANDED,
        outages_hourly=OUTAGES_HOURLY,
        outage_grid=_OUTAGE_GRID,
    ),
    doubles="current_outage_mw peak_24h_mw peak_168h_mw",
)
def outage_kpis(spark, sf_dir):
    """G-19."""
    g = filled_grid(spark, sf_dir).select("zone", "timestamp_utc")
    return metrics.outage_kpis(silver.align_outages(g, intervals.hourly_outages(expanded(spark, sf_dir))))


@query(
    with_views(
        """select g.zone, 100 * avg(coalesce(p.scheduled_net_position_mw * g.imbalance_mwh < 0, false)::int) as diverging_pct,
                  corr(p.scheduled_net_position_mw, g.imbalance_mwh) as correlation
           from grid_hourly g asof left join gated p on g.zone = p.zone and g.timestamp_utc >= p.gate_utc group by 1""",
        "grid_hourly",
        "net_positions",
        gated=GATED,
    ),
    doubles="diverging_pct correlation",
)
def divergence_kpis(spark, sf_dir):
    """G-20."""
    g = fx.grid_hourly(spark, sf_dir).select("zone", "timestamp_utc", "imbalance_mwh")
    return metrics.divergence(silver.align_net_positions(g, fx.net_positions(spark, sf_dir)))


def _ranked(n, direction):
    return f"""select zone, timestamp_utc, load_mw from (select *, row_number() over (partition by zone order by timestamp_utc {direction}) as rk
               from grid_hourly) where rk <= {n}"""


@query(with_views(_ranked(168, "desc"), "grid_hourly"), doubles="load_mw")
def last_rows_per_zone(spark, sf_dir):
    """T-02: the horizon of a dashboard."""
    return metrics.latest(fx.grid_hourly(spark, sf_dir), 168).select("zone", "timestamp_utc", "load_mw")


@query(with_views(_ranked(336, "asc"), "grid_hourly"), doubles="load_mw")
def first_rows_per_zone(spark, sf_dir):
    """T-04."""
    return metrics.earliest(fx.grid_hourly(spark, sf_dir), 336).select("zone", "timestamp_utc", "load_mw")


@query(
    with_views(
        "select period_utc, count(*) as n from (select make_date(left(raw_quarter_str, 4)::int, (right(raw_quarter_str, 1)::int - 1) * 3 + 1, 1)::timestamp as period_utc "
        "from housing_kommun) where period_utc between timestamp '1996-04-01' and timestamp '1998-10-01' group by 1",
        "housing_kommun",
    )
)
def quarter_window(spark, sf_dir):
    """S-18: quarters from 1996K2 to 1998K4, both included."""
    h = fx.housing_kommun(spark, sf_dir).select(periods.quarter_start(F.col("raw_quarter_str")).alias("period_utc"))
    low, high = (periods.quarter_start(F.lit(q)) for q in ("1996K2", "1998K4"))
    return h.where(F.col("period_utc").between(low, high)).groupBy("period_utc").agg(F.count("*").alias("n"))

"""Queries for as-of joins, interval expansion and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from causalgrid.operators import asof, dims, intervals, rollup
from causalgrid.operators.asof import Series
from causalgrid.plans import silver
from causalgrid.workload import fixtures as fx
from causalgrid.workload.fixtures import table, with_views
from causalgrid.workload.registry import query
from causalgrid.workload.series import FILLED, FILLED_DAILY, daily_filled, filled_grid


@query(
    with_views(
        """select g.zone, g.timestamp_utc, r.policy_rate_pct as riksbank_policy_rate_pct
           from grid_daily g asof left join policy_rate r on g.timestamp_utc >= r.effective_date_utc""",
        "grid_daily",
        "policy_rate",
    ),
    doubles="riksbank_policy_rate_pct",
)
def asof_policy_rate(spark, sf_dir):
    """J-01: the rate in force, through a calendar-sized map."""
    g = fx.grid_daily(spark, sf_dir).select("zone", "timestamp_utc")
    return silver.align_policy_rate(g, fx.policy_rate(spark, sf_dir))


@query(
    with_views(
        """select g.zone, g.timestamp_utc, r.policy_rate_pct
           from grid_daily g asof left join policy_rate r on g.timestamp_utc >= r.effective_date_utc""",
        "grid_daily",
        "policy_rate",
    ),
    doubles="policy_rate_pct",
)
def asof_policy_rate_stream(spark, sf_dir):
    """J-00: the same by the general operator, without key."""
    g = fx.grid_daily(spark, sf_dir).select("zone", "timestamp_utc")
    series = Series(fx.policy_rate(spark, sf_dir), "effective_date_utc", ("policy_rate_pct",))
    return asof.asof_join(g, series, by=())


HOUSING_ZONE = """
    select make_date(left(raw_quarter_str, 4)::int, (right(raw_quarter_str, 1)::int - 1) * 3 + 1, 1)::timestamp as period_utc, bidding_zone,
           sum(smahus_construction_index) as smahus_construction_index, avg(smahus_price_index) as smahus_price_index
    from housing_kommun join kommun_zone using (kommunkod) where bidding_zone is not null group by 1, 2"""


def housing_zone(spark, sf_dir):
    return rollup.housing_quarters(fx.housing_kommun(spark, sf_dir), fx.kommun_zone(spark, sf_dir), "raw_quarter_str").withColumnRenamed(
        "raw_quarter_str", "period_utc"
    )


@query(
    with_views(
        """select g.zone, g.timestamp_utc, h.smahus_construction_index, h.smahus_price_index from grid_daily g asof left join housing_zone h
           on g.zone = h.bidding_zone and g.timestamp_utc >= h.period_utc""",
        "grid_daily",
        "housing_kommun",
        "kommun_zone",
        housing_zone=HOUSING_ZONE,
    ),
    doubles="smahus_construction_index smahus_price_index",
    digits=4,
)
def asof_housing(spark, sf_dir):
    """J-02: the current quarter of the zone."""
    g = fx.grid_daily(spark, sf_dir).select("zone", "timestamp_utc")
    return silver.align_housing(g, housing_zone(spark, sf_dir))


GATED = """
    select zone, date_trunc('day', timestamp_utc)::timestamp - interval 12 hour as gate_utc,
           arg_max(scheduled_net_position_mw, timestamp_utc) as scheduled_net_position_mw from net_positions group by 1, 2"""


@query(
    with_views(
        """select g.zone, g.timestamp_utc, p.scheduled_net_position_mw from grid_hourly g asof left join gated p
           on g.zone = p.zone and g.timestamp_utc >= p.gate_utc""",
        "grid_hourly",
        "net_positions",
        gated=GATED,
    ),
    doubles="scheduled_net_position_mw",
)
def asof_net_position(spark, sf_dir):
    """J-03: the last position behind the latest closed gate."""
    g = fx.grid_hourly(spark, sf_dir).select("zone", "timestamp_utc")
    return silver.align_net_positions(g, fx.net_positions(spark, sf_dir))


@query(
    with_views(
        """select g.zone, g.timestamp_utc, p.scheduled_net_position_mw from grid_filled g left join net_positions p using (zone, timestamp_utc)""",
        "grid_hourly",
        "net_positions",
        **FILLED,
    ),
    doubles="scheduled_net_position_mw",
)
def net_position_by_delivery(spark, sf_dir):
    """J-03, what operators mean: the position for this very hour."""
    g = filled_grid(spark, sf_dir).select("zone", "timestamp_utc")
    return silver.align_net_positions(g, fx.net_positions(spark, sf_dir), mode="delivery")


HYDRO_PUBLISHED = """
    select reservoir_fill_ratio, make_date(year, 1, 4) - ((isodow(make_date(year, 1, 4)) - 1) - week_of_year * 7)::int as day from hydro_weekly"""


@query(
    with_views(
        """select g.zone, g.timestamp_utc, h.reservoir_fill_ratio from grid_daily g asof left join hydro_published h on g.timestamp_utc >= h.day::timestamp""",
        "grid_daily",
        "hydro_weekly",
        hydro_published=HYDRO_PUBLISHED,
    ),
    doubles="reservoir_fill_ratio",
)
def asof_hydro(spark, sf_dir):
    """J-04: the last published week; the gap filling after it finds nothing to do."""
    from causalgrid.workload.series import DAILY

    g = fx.grid_daily(spark, sf_dir).select("zone", "timestamp_utc")
    return silver.align_hydro(g, fx.hydro_weekly(spark, sf_dir), DAILY)


WEATHER_SETTLED = """
    select zone, timestamp_utc, avg(temperature_c) as temperature_c, avg(wind_speed_ms) as wind_speed_ms, bool_or(is_anomaly) as is_anomaly
    from weather_obs group by 1, 2"""

WEATHER_NEAREST = """
    select zone, hour as timestamp_utc, arg_min(temperature_c, (gap, obs)) as temperature_c, arg_min(wind_speed_ms, (gap, obs)) as wind_speed_ms,
           arg_min(is_anomaly, (gap, obs)) as is_anomaly_weather
    from (select *, timestamp_utc as obs, abs(epoch_us(timestamp_utc) - epoch_us(hour)) as gap from (
            select *, date_trunc('hour', timestamp_utc) as hour from weather_settled
            union all select *, date_trunc('hour', timestamp_utc) + interval 1 hour from weather_settled))
    where gap <= 1800000000 group by 1, 2"""


@query(
    with_views(
        """select g.zone, g.timestamp_utc, temperature_c, wind_speed_ms, coalesce(is_anomaly_weather, false) as is_anomaly_weather
           from grid_hourly g left join weather_nearest w using (zone, timestamp_utc)""",
        "grid_hourly",
        "weather_obs",
        weather_settled=WEATHER_SETTLED,
        weather_nearest=WEATHER_NEAREST,
    ),
    doubles="temperature_c wind_speed_ms",
)
def nearest_weather(spark, sf_dir):
    """J-05: the nearest observation within half an hour."""
    g = fx.grid_hourly(spark, sf_dir).select("zone", "timestamp_utc")
    return silver.see_weather(g, fx.weather_obs(spark, sf_dir))


@query(
    with_views(
        """select g.zone, g.timestamp_utc, temperature_c, wind_speed_ms from grid_hourly g left join weather_nearest w using (zone, timestamp_utc)""",
        "grid_hourly",
        "weather_obs",
        weather_settled=WEATHER_SETTLED,
        weather_nearest=WEATHER_NEAREST,
    ),
    doubles="temperature_c wind_speed_ms",
)
def nearest_weather_stream(spark, sf_dir):
    """J-00 nearest with tolerance, by the general operator."""
    g = fx.grid_hourly(spark, sf_dir).select("zone", "timestamp_utc")
    settled = rollup.settle_weather(fx.weather_obs(spark, sf_dir))
    series = Series(settled, "timestamp_utc", ("temperature_c", "wind_speed_ms"))
    return asof.asof_join(g, series, direction="nearest", tolerance_seconds=1_800)


PERIOD = ("2024-01-05 00:00:00", "2024-01-25 00:00:00")

EXPANDED = f"""
    select event_id, unit, zone, unavailable_mw, unnest(generate_series(greatest(event_start, timestamp '{PERIOD[0]}'),
           least(event_stop, timestamp '{PERIOD[1]}') - interval 1 hour, interval 1 hour)) as timestamp_utc
    from outage_events where greatest(event_start, timestamp '{PERIOD[0]}') < least(event_stop, timestamp '{PERIOD[1]}')"""

OUTAGES_HOURLY = """
    select zone, timestamp_utc, sum(unavailable_mw) as outage_mw, count(distinct unit)::int as active_unit_count from expanded group by 1, 2"""


def expanded(spark, sf_dir):
    start, end = (F.lit(t).cast("timestamp") for t in PERIOD)
    return intervals.expand_hours(fx.outage_events(spark, sf_dir), start, end)


@query(with_views("select event_id, unit, zone, timestamp_utc from expanded", "outage_events", expanded=EXPANDED))
def outage_hours(spark, sf_dir):
    """J-14: outages cut to a period and spelled out per hour."""
    return expanded(spark, sf_dir).select("event_id", "unit", "zone", "timestamp_utc")


@query(
    with_views("select * from outages_hourly", "outage_events", expanded=EXPANDED, outages_hourly=OUTAGES_HOURLY),
    doubles="outage_mw",
)
def outages_per_hour(spark, sf_dir):
    """G-02: MW and distinct units out of service."""
    return intervals.hourly_outages(expanded(spark, sf_dir))


@query(
    with_views(
        """select g.zone, g.timestamp_utc, coalesce(outage_mw, 0) as outage_mw, coalesce(active_unit_count, 0) as active_unit_count
           from grid_hourly g left join outages_hourly o using (zone, timestamp_utc)""",
        "grid_hourly",
        "outage_events",
        expanded=EXPANDED,
        outages_hourly=OUTAGES_HOURLY,
    ),
    doubles="outage_mw",
)
def join_outages(spark, sf_dir):
    """J-06 and G-03."""
    g = fx.grid_hourly(spark, sf_dir).select("zone", "timestamp_utc")
    return silver.align_outages(g, intervals.hourly_outages(expanded(spark, sf_dir)))


@query(
    with_views(
        """select coalesce(t.zone, w.zone) as zone, coalesce(t.hour, w.hour) as timestamp_utc, temperature_c, wind_speed_ms,
                  coalesce(t.a, false) or coalesce(w.a, false) as is_anomaly
           from (select zone, date_trunc('hour', timestamp_utc) as hour, avg(temperature_c) as temperature_c, bool_or(is_anomaly) as a
                 from weather_obs where event_id % 3 > 0 group by 1, 2) t
           full join (select zone, date_trunc('hour', timestamp_utc) as hour, avg(wind_speed_ms) as wind_speed_ms, bool_or(is_anomaly) as a
                 from weather_obs where event_id % 3 < 2 group by 1, 2) w on t.zone = w.zone and t.hour = w.hour""",
        "weather_obs",
    ),
    doubles="temperature_c wind_speed_ms",
)
def merge_weather_parameters(spark, sf_dir):
    """J-07: temperature and wind come separately; the zone is part of the key (W-23)."""
    obs = fx.weather_obs(spark, sf_dir).withColumn("timestamp_utc", F.date_trunc("hour", "timestamp_utc"))
    hourly = [
        obs.where(part).groupBy("zone", "timestamp_utc").agg(F.avg(c).alias(c), F.bool_or("is_anomaly").alias("is_anomaly"))
        for part, c in (("event_id % 3 > 0", "temperature_c"), ("event_id % 3 < 2", "wind_speed_ms"))
    ]
    return rollup.merge_parameters(*hourly, ["zone", "timestamp_utc"])


@query(
    with_views(
        """select coalesce(t.zone, w.zone) as zone, coalesce(t.hour, w.hour) as timestamp_utc, temperature_c, wind_speed_ms,
                  coalesce(t.a, false) or coalesce(w.a, false) as is_anomaly, t.q as quality_flag_temp, w.q as quality_flag_wind, coalesce(t.s, w.s) as station_id
           from (select zone, date_trunc('hour', timestamp_utc) as hour, avg(temperature_c) as temperature_c, bool_or(is_anomaly) as a,
                        max(case when event_id % 5 > 0 then 'G' else 'Y' end) as q, min(event_id % 9)::int as s
                 from weather_obs where event_id % 3 > 0 group by 1, 2) t
           full join (select zone, date_trunc('hour', timestamp_utc) as hour, avg(wind_speed_ms) as wind_speed_ms, bool_or(is_anomaly) as a,
                        max(case when event_id % 4 > 0 then 'G' else 'R' end) as q, max(event_id % 9)::int as s
                 from weather_obs where event_id % 3 < 2 group by 1, 2) w on t.zone = w.zone and t.hour = w.hour""",
        "weather_obs",
    ),
    doubles="temperature_c wind_speed_ms",
)
def merge_weather_quality(spark, sf_dir):
    """J-07: both quality flags and the station survive, whichever side an hour comes from."""
    obs = fx.weather_obs(spark, sf_dir).withColumn("timestamp_utc", F.date_trunc("hour", "timestamp_utc"))

    def hourly(part, value, quality, pick):
        by = obs.where(part).groupBy("zone", "timestamp_utc")
        flag = F.max(F.when(quality > 0, "G").otherwise("Y" if value == "temperature_c" else "R"))
        station = pick(F.col("event_id") % 9).cast("int").alias("station_id")
        return by.agg(F.avg(value).alias(value), F.bool_or("is_anomaly").alias("is_anomaly"), flag.alias("quality_flag"), station)

    temperature = hourly("event_id % 3 > 0", "temperature_c", F.col("event_id") % 5, F.min)
    wind = hourly("event_id % 3 < 2", "wind_speed_ms", F.col("event_id") % 4, F.max)
    return rollup.merge_parameters(temperature, wind, ["zone", "timestamp_utc"])


@query(
    with_views("select h.*, bidding_zone from housing_kommun h left join kommun_zone using (kommunkod)", "housing_kommun", "kommun_zone"),
    doubles="smahus_construction_index smahus_price_index",
    digits=4,
)
def kommun_to_zone(spark, sf_dir):
    """J-08: codes without a zone stay, with NULL."""
    return dims.with_zone(fx.housing_kommun(spark, sf_dir), fx.kommun_zone(spark, sf_dir))


@query(
    """select c_custkey, c_nationkey, coalesce(n_name, 'Okänd (' || c_nationkey || ')') as n_name
       from customer left join (select * from nation where n_regionkey <> 3) on c_nationkey = n_nationkey"""
)
def region_labels(spark, sf_dir):
    """J-09: a name for every code."""
    names = table(spark, sf_dir, "nation").where("n_regionkey <> 3").withColumnRenamed("n_nationkey", "c_nationkey")
    return dims.with_label(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), names, "c_nationkey", "n_name")


@query(
    with_views(
        """select event_id, zone, station_id from (select event_id, zone, (case event_id % 5 when 0 then 140480 when 1 then 86340 when 2 then 98210
             when 3 then 62040 else 7 end)::int as station_id from weather_obs)
           where not coalesce(case station_id when 140480 then 'SE1' when 86340 then 'SE2' when 98210 then 'SE3' when 62040 then 'SE4' end = zone, false)""",
        "weather_obs",
    )
)
def foreign_stations(spark, sf_dir):
    """J-10: observations of unknown stations or stations of another zone."""
    k = F.col("event_id") % 5
    station = F.when(k == 0, 140480).when(k == 1, 86340).when(k == 2, 98210).when(k == 3, 62040).otherwise(7)
    obs = fx.weather_obs(spark, sf_dir).select("event_id", "zone", station.alias("station_id"))
    return dims.foreign_stations(obs, dims.stations(spark)).select("event_id", "zone", "station_id")


@query(
    with_views(
        """select zone, timestamp_utc, load_mw, imbalance_mwh, price_eur_mwh,
                  coalesce(l.a, false) or coalesce(i.a, false) or coalesce(p.a, false) as is_anomaly
           from (select zone, timestamp_utc, load_mw, is_anomaly and load_mw > 20000 as a from grid_hourly where load_mw is not null) l
           full join (select zone, timestamp_utc, imbalance_mwh, abs(imbalance_mwh) > 100 as a from grid_hourly where imbalance_mwh is not null) i
             using (zone, timestamp_utc)
           full join (select zone, timestamp_utc, price_eur_mwh, price_eur_mwh > 100 as a from grid_hourly where hour(timestamp_utc) <> 3) p
             using (zone, timestamp_utc)""",
        "grid_hourly",
    ),
    doubles="load_mw imbalance_mwh price_eur_mwh",
)
def merge_metrics(spark, sf_dir):
    """J-11: load, imbalance and price on one key, one shuffle."""
    g, key = fx.grid_hourly(spark, sf_dir), ["zone", "timestamp_utc"]
    load = g.where("load_mw is not null").select(*key, "load_mw", (F.col("is_anomaly") & (F.col("load_mw") > 20000)).alias("is_anomaly"))
    imbalance = g.where("imbalance_mwh is not null").select(*key, "imbalance_mwh", (F.abs("imbalance_mwh") > 100).alias("is_anomaly"))
    price = g.where(F.hour("timestamp_utc") != 3).select(*key, "price_eur_mwh", (F.col("price_eur_mwh") > 100).alias("is_anomaly"))
    return rollup.merge_metrics({"load_mw": load, "imbalance_mwh": imbalance, "price_eur_mwh": price})


@query(
    with_views("select * from housing_zone", "housing_kommun", "kommun_zone", housing_zone=HOUSING_ZONE),
    doubles="smahus_construction_index smahus_price_index",
    digits=4,
)
def merge_housing_series(spark, sf_dir):
    """J-12: both housing series per quarter and zone."""
    return housing_zone(spark, sf_dir)


@query(
    with_views(
        """select coalesce(c.raw_quarter_str, p.raw_quarter_str) as raw_quarter_str, coalesce(c.kommunkod, p.kommunkod) as kommunkod,
                  smahus_construction_index, smahus_price_index
           from (select raw_quarter_str, kommunkod, smahus_construction_index from housing_kommun where kommunkod % 5 > 0) c
           full join (select raw_quarter_str, kommunkod, smahus_price_index from housing_kommun where kommunkod % 7 > 0) p
           on c.raw_quarter_str = p.raw_quarter_str and c.kommunkod = p.kommunkod""",
        "housing_kommun",
    ),
    doubles="smahus_construction_index smahus_price_index",
    digits=4,
)
def merge_cubes(spark, sf_dir):
    """J-12, first half: the two statistics cubes side by side per municipality."""
    h, key = fx.housing_kommun(spark, sf_dir), ["raw_quarter_str", "kommunkod"]
    built = h.where("kommunkod % 5 > 0").select(*key, "smahus_construction_index")
    price = h.where("kommunkod % 7 > 0").select(*key, "smahus_price_index")
    return rollup.merge_cubes(built, price, key)


@query(
    """select event_id, u.unit, u.zone, u.installed_mw, a.zone as area_zone
       from (select event_id, (event_id % 10)::int as k, (event_id % 5)::int as j from events) e
       left join (values (0, 'FORSMARK_1', 'SE3', 1008.0), (1, 'FORSMARK_2', 'SE3', 1120.0), (2, 'FORSMARK_3', 'SE3', 1170.0),
                  (3, 'RINGHALS_3', 'SE3', 1063.0), (4, 'RINGHALS_4', 'SE3', 1130.0), (5, 'STENUNGSUND_B3', 'SE3', 630.0),
                  (6, 'KARLSHAMN_G1', 'SE4', 200.0), (7, 'KARLSHAMN_G2', 'SE4', 200.0), (8, 'KARLSHAMN_G3', 'SE4', 200.0)) u (k, unit, zone, installed_mw) using (k)
       left join (values (0, 'SE1'), (1, 'SE2'), (2, 'SE3'), (3, 'SE4')) a (j, zone) using (j)""",
    doubles="installed_mw",
)
def unit_and_area_labels(spark, sf_dir):
    """J-13: unit to zone and capacity, area code to zone."""
    def pick(n, values):
        return F.element_at(F.array(*[F.lit(v) for v in values], F.lit("?")), (F.col("event_id") % n + 1).cast("int"))

    e = table(spark, sf_dir, "events").select(
        "event_id", pick(10, dims.UNITS).alias("unit"), pick(5, dims.AREA_CODE).alias("area_code")
    )
    areas = dims.area_codes(spark).withColumnRenamed("zone", "area_zone")
    named = e.join(dims.units(spark), "unit", "left").join(areas, "area_code", "left")
    unit = F.when(F.col("zone").isNotNull(), F.col("unit")).alias("unit")
    return named.select("event_id", unit, "zone", "installed_mw", "area_zone")


@query(
    with_views(
        """select kommunkod, case when kommunkod % 4 = 0 then 'SE9' else bidding_zone end as bidding_zone from kommun_zone
           union all select 1000 + n_nationkey, 'SE9' from nation where n_nationkey % 4 = 0""",
        "kommun_zone",
    )
)
def override_mapping(spark, sf_dir):
    """J-15: supplied codes replace and extend the default ones."""
    default = fx.kommun_zone(spark, sf_dir).select("kommunkod", "bidding_zone")
    some = table(spark, sf_dir, "nation").where("n_nationkey % 4 = 0")
    nine = F.lit("SE9").alias("bidding_zone")
    extra = some.select(F.col("n_nationkey").alias("kommunkod"), nine)
    more = some.select((F.col("n_nationkey") + 1000).alias("kommunkod"), nine)
    return dims.overridden(default, extra.unionByName(more), "kommunkod")


SILVER_VIEWS = {
    **FILLED,
    "gated": GATED,
    "weather_settled": WEATHER_SETTLED,
    "weather_nearest": WEATHER_NEAREST,
    "expanded": EXPANDED,
    "outages_hourly": OUTAGES_HOURLY,
    "weather_on_grid": """
        select g.zone, g.timestamp_utc, g.rn, temperature_c as t, wind_speed_ms as w, coalesce(is_anomaly_weather, false) as is_anomaly_weather
        from grid_filled g left join weather_nearest using (zone, timestamp_utc)""",
}
for _c in ("t", "w"):
    SILVER_VIEWS[f"weather_{_c}"] = f"""
        select zone, timestamp_utc, coalesce({_c}, case when rn - pi <= 3 then coalesce(p + (n - p) * (rn - pi) / (ni - pi), p) end) as v
        from (select *, last_value({_c} ignore nulls) over up as p, max(case when {_c} is not null then rn end) over up as pi,
              first_value({_c} ignore nulls) over down as n, min(case when {_c} is not null then rn end) over down as ni
              from weather_on_grid
              window up as (partition by zone order by rn rows between unbounded preceding and current row),
                     down as (partition by zone order by rn rows between current row and unbounded following))"""
SILVER_VIEWS["silver_hourly"] = """
    select g.timestamp_utc, g.zone, g.load_mw, g.imbalance_mwh, g.price_eur_mwh, null::double as smahus_construction_index,
           null::double as smahus_price_index, null::double as riksbank_policy_rate_pct, g.is_anomaly,
           g.is_anomaly or (g.load_mw is null and g.imbalance_mwh is null) as is_quarantined, g.has_imputed_grid,
           p.scheduled_net_position_mw, wt.v as temperature_c, ww.v as wind_speed_ms, wg.is_anomaly_weather,
           coalesce(o.outage_mw, 0) as outage_mw, coalesce(o.active_unit_count, 0) as active_unit_count
    from grid_filled g asof left join gated p on g.zone = p.zone and g.timestamp_utc >= p.gate_utc
    join weather_t wt on wt.zone = g.zone and wt.timestamp_utc = g.timestamp_utc
    join weather_w ww on ww.zone = g.zone and ww.timestamp_utc = g.timestamp_utc
    join weather_on_grid wg on wg.zone = g.zone and wg.timestamp_utc = g.timestamp_utc
    left join outages_hourly o on o.zone = g.zone and o.timestamp_utc = g.timestamp_utc"""
HOURLY_INPUTS = ("grid_hourly", "net_positions", "weather_obs", "outage_events")


def silver_hourly(spark, sf_dir):
    return silver.build_silver(
        fx.grid_hourly(spark, sf_dir),
        weather=fx.weather_obs(spark, sf_dir),
        outages=intervals.hourly_outages(expanded(spark, sf_dir)),
        net_positions=fx.net_positions(spark, sf_dir),
    )


@query(
    with_views("select * from silver_hourly", *HOURLY_INPUTS, **SILVER_VIEWS),
    doubles="load_mw imbalance_mwh price_eur_mwh scheduled_net_position_mw temperature_c wind_speed_ms outage_mw",
)
def silver_with_weather_and_market(spark, sf_dir):
    """The aligned table with hourly inputs (P-19, A-07 included)."""
    return silver_hourly(spark, sf_dir)


SILVER_DAILY = """
    select g.timestamp_utc, g.zone, g.load_mw, g.imbalance_mwh, g.price_eur_mwh, h.smahus_construction_index, h.smahus_price_index,
           r.policy_rate_pct as riksbank_policy_rate_pct, false as is_anomaly, g.load_mw is null and g.imbalance_mwh is null as is_quarantined,
           g.has_imputed_grid, w.reservoir_fill_ratio
    from daily_filled g asof left join housing_zone h on g.zone = h.bidding_zone and g.timestamp_utc >= h.period_utc
    asof left join policy_rate r on g.timestamp_utc >= r.effective_date_utc
    asof left join hydro_published w on g.timestamp_utc >= w.day::timestamp"""
DAILY_INPUTS = ("grid_daily", "policy_rate", "housing_kommun", "kommun_zone", "hydro_weekly")
DAILY_VIEWS = {**FILLED_DAILY, "housing_zone": HOUSING_ZONE, "hydro_published": HYDRO_PUBLISHED, "silver_daily": SILVER_DAILY}


def silver_daily(spark, sf_dir):
    from causalgrid.workload.series import DAILY

    return silver.build_silver(
        fx.grid_daily(spark, sf_dir),
        quarterly=housing_zone(spark, sf_dir),
        rates=fx.policy_rate(spark, sf_dir),
        hydro=fx.hydro_weekly(spark, sf_dir),
        grid=DAILY,
    )


@query(
    with_views("select * from silver_daily", *DAILY_INPUTS, **DAILY_VIEWS),
    doubles="load_mw imbalance_mwh price_eur_mwh smahus_construction_index smahus_price_index riksbank_policy_rate_pct reservoir_fill_ratio",
    digits=4,
)
def silver_with_macro_series(spark, sf_dir):
    """The aligned table with quarterly, weekly and event-driven inputs, at daily grain."""
    return silver_daily(spark, sf_dir)

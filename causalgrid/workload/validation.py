"""Queries for record validation, anomaly flags and quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from causalgrid.functions import periods
from causalgrid.operators import validate as v
from causalgrid.workload import fixtures as fx
from causalgrid.workload.fixtures import table, with_views
from causalgrid.workload.registry import query

_ZONE = "zone in ('SE1', 'SE2', 'SE3', 'SE4')"


def _failed(**rules: str) -> str:
    """The SQL twin of ``named_failures``; rules are SQL conditions."""
    marks = ", ".join(f"case when not coalesce({ok}, false) then '{name}' end" for name, ok in rules.items())
    return f"concat_ws(',', {marks})"


def _checked(df, rules, *columns):
    out = v.validate(df, rules)
    return out.select(*columns, F.concat_ws(",", "failed_rules").alias("failed_rules"), "is_valid")


def _zone5():
    """One user in nine lies in a zone that does not exist."""
    return F.concat(F.lit("SE"), F.when(F.col("user_id") % 9 == 0, 5).otherwise(F.col("user_id") % 4 + 1).cast("string"))


_ZONE5 = "'SE' || (case when user_id % 9 = 0 then 5 else user_id % 4 + 1 end)::varchar"


def _with_valid(select: str) -> str:
    return f"select *, failed_rules = '' as is_valid from ({select})"


@query(
    _with_valid(
        f"""select event_id, {_failed(zone=_ZONE, timestamp_utc='timestamp_utc is not null', load_mw='load_mw >= 0',
            resolution_minutes='resolution_minutes between 1 and 1440')} as failed_rules
        from (select event_id, {_ZONE5} as zone, case when event_id % 50 > 0 then ts end as timestamp_utc, value - 5 as load_mw,
              event_id % 1500 as resolution_minutes from events)"""
    )
)
def validate_load(spark, sf_dir):
    """V-01."""
    e = table(spark, sf_dir, "events")
    points = e.select(
        "event_id",
        _zone5().alias("zone"),
        F.when(F.col("event_id") % 50 > 0, F.col("ts")).alias("timestamp_utc"),
        (F.col("value") - 5).alias("load_mw"),
        (F.col("event_id") % 1500).alias("resolution_minutes"),
    )
    return _checked(points, v.load_rules(), "event_id")


@query(
    _with_valid(
        f"""select event_id, {_failed(zone=_ZONE, timestamp_utc='timestamp_utc is not null', imbalance_mwh='imbalance_mwh is not null')} as failed_rules,
        coalesce((direction = 'A01' and imbalance_mwh < 0) or (direction = 'A02' and imbalance_mwh > 0), false) as direction_warning
        from (select event_id, {_ZONE5} as zone, ts as timestamp_utc, value - 50 as imbalance_mwh,
              case event_id % 3 when 0 then 'A01' when 1 then 'A02' end as direction from events)"""
    )
)
def validate_imbalance(spark, sf_dir):
    """V-02: the direction only warns."""
    k = F.col("event_id") % 3
    points = table(spark, sf_dir, "events").select(
        "event_id",
        _zone5().alias("zone"),
        F.col("ts").alias("timestamp_utc"),
        (F.col("value") - 50).alias("imbalance_mwh"),
        F.when(k == 0, "A01").when(k == 1, "A02").alias("direction"),
    )
    warned = points.withColumn("direction_warning", v.imbalance_warning())
    return _checked(warned, v.imbalance_rules(), "event_id", "direction_warning")


@query(
    _with_valid(
        f"""select event_id, {_failed(zone=_ZONE, timestamp_utc='ts is not null', price_eur_mwh='value is not null')} as failed_rules
        from (select *, {_ZONE5} as zone from events)"""
    )
)
def validate_price(spark, sf_dir):
    """V-03."""
    e = table(spark, sf_dir, "events").withColumn("zone", _zone5())
    return _checked(e.withColumnsRenamed({"ts": "timestamp_utc", "value": "price_eur_mwh"}), v.price_rules(), "event_id")


@query(
    _with_valid(
        f"""select o_orderkey, {_failed(kommunkod='kommunkod between 114 and 2584', region_name='length(trim(region_name)) > 0',
            smahus_price_index='smahus_price_index >= 0', raw_quarter_str="regexp_full_match(raw_quarter_str, '[0-9]{4}K[1-4]')")} as failed_rules
        from (select o_orderkey, (o_custkey * 7 % 2700)::int as kommunkod, case when o_orderkey % 13 = 0 then ' ' else o_orderpriority end as region_name,
              o_totalprice - 20000 as smahus_price_index,
              year(o_orderdate)::varchar || case when o_orderkey % 17 = 0 then 'k' else 'K' end || quarter(o_orderdate)::varchar as raw_quarter_str
              from orders)"""
    )
)
def validate_housing(spark, sf_dir):
    """V-04: lower-case quarters can be read but are no valid records."""
    key = F.col("o_orderkey")
    letter = F.when(key % 17 == 0, "k").otherwise("K")
    records = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_custkey") * 7 % 2700).cast("int").alias("kommunkod"),
        F.when(key % 13 == 0, " ").otherwise(F.col("o_orderpriority")).alias("region_name"),
        (F.col("o_totalprice") - 20000).alias("smahus_price_index"),
        F.concat(F.year("o_orderdate").cast("string"), letter, F.quarter("o_orderdate").cast("string")).alias("raw_quarter_str"),
    )
    return _checked(records, v.housing_rules("smahus_price_index"), "o_orderkey")


@query(
    _with_valid(
        f"""select o_orderkey, {_failed(policy_rate_pct='rate between -2 and 15', raw_date_str="regexp_full_match(raw, '[0-9]{4}-[0-9]{2}-[0-9]{2}')",
            effective_date_utc="eff = date_trunc('day', o_orderdate) and o_orderkey % 6 > 0")} as failed_rules
        from (select o_orderkey, o_orderdate, o_totalprice / 20000 - 3 as rate,
              case when o_orderkey % 6 = 0 then strftime(o_orderdate, '%d/%m/%Y') else strftime(o_orderdate, '%Y-%m-%d') end as raw,
              date_trunc('day', o_orderdate) + case when o_orderkey % 8 = 0 then interval 1 day else interval 0 day end as eff from orders)"""
    )
)
def validate_rate(spark, sf_dir):
    """V-05."""
    key, day = F.col("o_orderkey"), F.date_trunc("day", "o_orderdate")
    points = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") / 20000 - 3).alias("policy_rate_pct"),
        F.when(key % 6 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("raw_date_str"),
        F.when(key % 8 == 0, F.timestamp_add("DAY", F.lit(1), day)).otherwise(day).alias("effective_date_utc"),
    )
    return _checked(points, v.rate_rules(), "o_orderkey")


@query(
    """select p_partkey, not regexp_matches(lower(series_name), 'repo|policy|styrränta|ränta') as unexpected
       from (select p_partkey, p_name || case when p_partkey % 3 = 0 then ' Styrränta' else '' end as series_name from part)"""
)
def rate_series_names(spark, sf_dir):
    """V-06: a warning only."""
    name = F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, " Styrränta").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("series_name")).select(
        "p_partkey", v.rate_series_warning().alias("unexpected")
    )


@query(
    _with_valid(
        f"""select event_id, {_failed(value='event_id % 19 > 0', epoch_ms='event_id % 23 > 0')} as failed_rules from events"""
    )
)
def validate_weather(spark, sf_dir):
    """V-07: a decimal comma is fine."""
    key = F.col("event_id")
    number = F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))
    points = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(key % 19 == 0, "saknas").otherwise(number).alias("value"),
        F.when(key % 23 == 0, F.lit(0)).otherwise(F.unix_millis("ts")).alias("epoch_ms"),
    )
    return _checked(points, v.weather_rules(), "event_id")


_STATIONS = """select s_suppkey, s_acctbal / 90 as latitude, s_acctbal / 40 as longitude, s_suppkey % 40 as total_records,
        s_suppkey % 37 as failed_records from supplier"""


@query(
    _with_valid(
        f"""select s_suppkey, {_failed(latitude='latitude between -90 and 90', longitude='longitude between -180 and 180',
            total_records='total_records >= 0', failed_records='failed_records between 0 and total_records')} as failed_rules from ({_STATIONS})"""
    )
)
def validate_stations(spark, sf_dir):
    """V-08."""
    s = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        (F.col("s_acctbal") / 90).alias("latitude"),
        (F.col("s_acctbal") / 40).alias("longitude"),
        (F.col("s_suppkey") % 40).alias("total_records"),
        (F.col("s_suppkey") % 37).alias("failed_records"),
    )
    return _checked(s, v.station_rules(), "s_suppkey")


@query(
    with_views(
        _with_valid(
            f"""select event_id, {_failed(zone=_ZONE, timestamp_utc='true', outage_mw='unavailable_mw * 3 - 50 between 0 and 5000')} as failed_rules
            from outage_events"""
        ),
        "outage_events",
    )
)
def validate_outages(spark, sf_dir):
    """V-09."""
    events = fx.outage_events(spark, sf_dir).withColumn("outage_mw", F.col("unavailable_mw") * 3 - 50)
    return _checked(events.withColumnRenamed("event_start", "timestamp_utc"), v.outage_rules(), "event_id")


@query(
    with_views(
        _with_valid(
            f"""select zone, timestamp_utc, {_failed(zone=_ZONE, timestamp_utc='true', scheduled_net_position_mw='abs(p) <= 5000')} as failed_rules
            from (select *, scheduled_net_position_mw * 4 as p from net_positions)"""
        ),
        "net_positions",
    )
)
def validate_net_positions(spark, sf_dir):
    """V-10."""
    p = fx.net_positions(spark, sf_dir)
    scaled = p.withColumn("scheduled_net_position_mw", F.col("scheduled_net_position_mw") * 4)
    return _checked(scaled, v.net_position_rules(), "zone", "timestamp_utc")


@query(
    with_views(
        _with_valid(
            f"""select year, week_of_year, {_failed(year='y between 1990 and 2100',
                week_of_year="w between 1 and case when isodow(make_date(y, 1, 1)) = 4 or isodow(make_date(y, 12, 31)) = 4 then 53 else 52 end",
                reservoir_fill_ratio='f between 0 and 1')} as failed_rules
            from (select year, week_of_year, year - case when week_of_year = 7 then 10 else 0 end as y, week_of_year + 1 as w,
                  reservoir_fill_ratio * 2 as f from hydro_weekly)"""
        ),
        "hydro_weekly",
    )
)
def validate_hydro(spark, sf_dir):
    """V-11: week 53 only in long years."""
    h = fx.hydro_weekly(spark, sf_dir)
    shifted = h.select(
        F.col("year").alias("y"),
        F.col("week_of_year").alias("w"),
        (F.col("year") - F.when(F.col("week_of_year") == 7, 10).otherwise(0)).alias("year"),
        (F.col("week_of_year") + 1).alias("week_of_year"),
        (F.col("reservoir_fill_ratio") * 2).alias("reservoir_fill_ratio"),
    )
    checked = v.validate(shifted, v.hydro_rules())
    return checked.select(
        F.col("y").alias("year"), F.col("w").alias("week_of_year"), F.concat_ws(",", "failed_rules").alias("failed_rules"), "is_valid"
    )


@query(
    with_views(
        _with_valid(
            f"""select event_id, {_failed(zone=_ZONE, station_id='home is not null', station_zone='home = zone',
                measurement='temperature_c is not null or wind_speed_ms is not null')} as failed_rules
            from (select event_id, zone, case (event_id % 6)::int when 0 then 'SE1' when 1 then 'SE2' when 2 then 'SE3' when 3 then 'SE4' end as home,
                  case when event_id % 4 > 0 then temperature_c end as temperature_c,
                  case when event_id % 7 > 0 then wind_speed_ms end as wind_speed_ms from weather_obs)"""
        ),
        "weather_obs",
    )
)
def validate_silver_weather(spark, sf_dir):
    """V-12: station known, of this zone, and something measured."""
    from causalgrid.operators import dims

    key = F.col("event_id")
    k = key % 6
    station = F.when(k == 0, 140480).when(k == 1, 86340).when(k == 2, 98210).when(k == 3, 62040).otherwise(1)
    rows = fx.weather_obs(spark, sf_dir).select(
        "event_id",
        "zone",
        station.alias("station_id"),
        F.when(key % 4 > 0, F.col("temperature_c")).alias("temperature_c"),
        F.when(key % 7 > 0, F.col("wind_speed_ms")).alias("wind_speed_ms"),
    )
    known = dims.with_station_zone(rows, dims.stations(spark))
    return _checked(known, v.silver_weather_rules(F.col("station_zone")), "event_id")


@query(
    with_views(
        _with_valid(
            f"""select event_id, {_failed(zone=_ZONE, outage_mw='unavailable_mw - 100 >= 0',
                reservoir_fill_ratio='fill is null or fill between 0 and 1')} as failed_rules
            from (select *, case when event_id % 4 > 0 then unavailable_mw / 1000 end as fill from outage_events)"""
        ),
        "outage_events",
    )
)
def validate_silver_market(spark, sf_dir):
    """V-13."""
    fill = F.when(F.col("event_id") % 4 > 0, F.col("unavailable_mw") / 1000)
    rows = fx.outage_events(spark, sf_dir).withColumn("reservoir_fill_ratio", fill)
    return _checked(rows.withColumn("outage_mw", F.col("unavailable_mw") - 100), v.silver_market_rules(), "event_id")


@query(
    with_views(
        _with_valid(
            f"""select zone, timestamp_utc, {_failed(zone=_ZONE, timestamp_utc='true', load_mw='load_mw is null or load_mw - 1000 >= 0',
                is_anomaly='is_anomaly is not null', is_quarantined='true', has_imputed_grid='load_mw is not null')} as failed_rules
            from grid_hourly"""
        ),
        "grid_hourly",
    )
)
def validate_silver_grid(spark, sf_dir):
    """V-14."""
    g = fx.grid_hourly(spark, sf_dir)
    rows = g.withColumns(
        {
            "load_mw": F.col("load_mw") - 1000,
            "is_quarantined": F.lit(False),
            "has_imputed_grid": F.when(F.col("load_mw").isNotNull(), F.lit(False)),
        }
    )
    return _checked(rows, v.silver_grid_rules(), "zone", "timestamp_utc")


@query(
    with_views(
        """select zone, timestamp_utc, concat_ws(',', case when load_mw < 500 then 'load_below_minimum' end,
                  case when load_mw > 20000 then 'load_above_maximum' end, case when abs(imbalance_mwh) > 100 then 'imbalance_beyond_limit' end,
                  case when price_eur_mwh < 20 then 'price_below_minimum' end, case when price_eur_mwh > 100 then 'price_above_maximum' end) as reasons
           from grid_hourly""",
        "grid_hourly",
    )
)
def anomaly_reasons(spark, sf_dir):
    """A-01 to A-03 with limits that fit the data."""
    checks = {**v.load_anomaly(limits=(500.0, 20_000.0)), **v.imbalance_anomaly(limit=100.0), **v.price_anomaly(limits=(20.0, 100.0))}
    flagged = v.flag_anomalies(fx.grid_hourly(spark, sf_dir), checks)
    return flagged.select("zone", "timestamp_utc", F.concat_ws(",", "anomaly_reasons").alias("reasons"))


@query(
    """select event_id, bool_or(value > 250) over (partition by user_id % 4, date_trunc('hour', ts)) as is_anomaly from events"""
)
def anomaly_by_timestamp(spark, sf_dir):
    """A-04: every row of a flagged (zone, hour) is flagged."""
    e = table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % 4).alias("zone"),
        F.date_trunc("hour", "ts").alias("timestamp_utc"),
        (F.col("value") > 250).alias("is_anomaly"),
    )
    return v.spread_flag(e).select("event_id", "is_anomaly")


@query(
    with_views(
        """select event_id, coalesce(t < -50 or t > 40, false) as temperature_anomaly, coalesce(w < 0 or w > 70, false) as wind_anomaly
           from (select event_id, case when event_id % 5 > 0 then temperature_c * 3 - 45 end as t,
                 case when event_id % 3 > 0 then wind_speed_ms * 5 - 5 end as w from weather_obs)""",
        "weather_obs",
    )
)
def weather_anomalies(spark, sf_dir):
    """A-05 and A-06: missing values are not anomalous."""
    key = F.col("event_id")
    t = F.when(key % 5 > 0, F.col("temperature_c") * 3 - 45)
    w = F.when(key % 3 > 0, F.col("wind_speed_ms") * 5 - 5)
    return fx.weather_obs(spark, sf_dir).select(
        "event_id",
        v.outside(t, *v.TEMPERATURE_C).alias("temperature_anomaly"),
        v.outside(w, *v.WIND_MS).alias("wind_anomaly"),
    )


@query(
    with_views(
        "select zone, timestamp_utc, is_anomaly or (load_mw is null and imbalance_mwh is null) as is_quarantined from grid_hourly",
        "grid_hourly",
    )
)
def quarantine_rows(spark, sf_dir):
    """A-07."""
    return v.quarantine(fx.grid_hourly(spark, sf_dir)).select("zone", "timestamp_utc", "is_quarantined")


@query(
    with_views(
        """select failed_rules, count(*) as n from (
             select concat_ws(',', case when value - 5 < 0 then 'load_mw' end, case when user_id % 9 = 0 then 'zone' end) as failed_rules from events)
           where failed_rules <> '' group by 1"""
    )
)
def reject_reasons(spark, sf_dir):
    """K-08: the rejects by reason."""
    e = table(spark, sf_dir, "events").withColumn("zone", _zone5()).withColumn("load_mw", F.col("value") - 5)
    rules = {"load_mw": F.col("load_mw") >= 0, "zone": v.zone_known()}
    _, rejects = v.split_valid(v.validate(e, rules))
    return rejects.groupBy(F.concat_ws(",", "failed_rules").alias("failed_rules")).agg(F.count("*").alias("n"))

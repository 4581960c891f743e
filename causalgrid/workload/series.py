"""Queries for regularising, gap filling and trailing statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from causalgrid.operators import chunks, regular
from causalgrid.operators.chunks import DAY, Grid
from causalgrid.operators.rolling import Rolling, min_periods, rolling
from causalgrid.workload import fixtures as fx
from causalgrid.workload.fixtures import with_views
from causalgrid.workload.registry import query

HOURLY = Grid()
DAILY = Grid(step_seconds=DAY)
WEEK = 168

_PREV = "over (partition by zone order by rn rows between unbounded preceding and current row)"
_NEXT = "over (partition by zone order by rn rows between current row and unbounded following)"


def filled_views(base: str, step: str, prefix: str = "grid") -> dict[str, str]:
    """SQL twin of ``regularize``: every step between a zone's first and last row, gaps filled."""
    flag = "coalesce(g.is_anomaly, false)" if base == "grid_hourly" else "false"
    full = f"""
    select s.zone, s.timestamp_utc, g.load_mw, g.imbalance_mwh, g.price_eur_mwh, {flag} as is_anomaly,
           row_number() over (partition by s.zone order by s.timestamp_utc) as rn
    from (select zone, unnest(generate_series(min(timestamp_utc), max(timestamp_utc), interval 1 {step})) as timestamp_utc
          from {base} group by zone) s
    left join {base} g on g.zone = s.zone and g.timestamp_utc = s.timestamp_utc"""
    marked = f"""
    select *, last_value(load_mw ignore nulls) {_PREV} as lp, first_value(load_mw ignore nulls) {_NEXT} as ln,
           max(case when load_mw is not null then rn end) {_PREV} as lpi,
           min(case when load_mw is not null then rn end) {_NEXT} as lni,
           last_value(imbalance_mwh ignore nulls) {_PREV} as ip,
           max(case when imbalance_mwh is not null then rn end) {_PREV} as ipi,
           last_value(price_eur_mwh ignore nulls) {_PREV} as pp,
           max(case when price_eur_mwh is not null then rn end) {_PREV} as ppi
    from {prefix}_full"""
    filled = f"""
    select zone, timestamp_utc, rn,
           coalesce(load_mw, case when rn - lpi <= 6 then coalesce(lp + (ln - lp) * (rn - lpi) / (lni - lpi), lp) end) as load_mw,
           coalesce(imbalance_mwh, case when rn - ipi <= 6 then ip end) as imbalance_mwh,
           coalesce(price_eur_mwh, case when rn - ppi <= 6 then pp end) as price_eur_mwh,
           is_anomaly, load_mw is null as has_imputed_grid
    from {prefix}_marked"""
    return {f"{prefix}_full": full, f"{prefix}_marked": marked, f"{prefix}_filled": filled}


FILLED = filled_views("grid_hourly", "hour")
FILLED_DAILY = filled_views("grid_daily", "day", "daily")


def filled_grid(spark, sf_dir):
    return regular.regularize(
        fx.grid_hourly(spark, sf_dir),
        HOURLY,
        linear={"load_mw": 6},
        ffill={"imbalance_mwh": 6, "price_eur_mwh": 6},
        flags=["is_anomaly"],
        imputed_from="load_mw",
    )


@query(
    with_views(
        "select zone, timestamp_utc, load_mw, imbalance_mwh, price_eur_mwh, is_anomaly, has_imputed_grid from grid_filled",
        "grid_hourly",
        **FILLED,
    ),
    doubles="load_mw imbalance_mwh price_eur_mwh",
)
def calendar_fill(spark, sf_dir):
    """W-10 to W-13: every hour present, load interpolated and the rest held for six hours."""
    return filled_grid(spark, sf_dir)


@query(
    """select zone, why as unplaced_reason, count(*) as n from (
         select zone, case when zone is null then 'no_key' when ts is null then 'no_time' when epoch_us(ts) % 60000000 <> epoch_us(min(ts) over (partition by zone)) % 60000000 then 'off_phase' end as why
         from (select case when event_id % 7 > 0 then 'SE' || (user_id % 4 + 1)::varchar end as zone, case when event_id % 11 > 0 then ts end as ts from events))
       where why is not null group by all"""
)
def unplaced_rows(spark, sf_dir):
    """W-10: events on a grid of minutes; rows without zone or time, and those off their zone's grid, are counted by reason."""
    e = fx.table(spark, sf_dir, "events")
    zone = F.when(F.col("event_id") % 7 > 0, F.concat(F.lit("SE"), (F.col("user_id") % 4 + 1).cast("string")))
    rows = e.select(zone.alias("zone"), F.when(F.col("event_id") % 11 > 0, F.col("ts")).alias("timestamp_utc"))
    return regular.unplaced_counts(rows, Grid(step_seconds=60))


@query(
    with_views(
        """select zone, count(*) as n_rows, count_if(gap > 1.5) as n_gaps, max(gap) as largest_gap_h,
                  (date_diff('hour', min(timestamp_utc), max(timestamp_utc)) + 1 - count(*)) as implicit_gap_hours
           from (select zone, timestamp_utc, date_diff('minute', lag(timestamp_utc) over (partition by zone order by timestamp_utc), timestamp_utc) / 60.0 as gap
                 from grid_hourly) group by zone""",
        "grid_hourly",
    ),
    doubles="largest_gap_h",
)
def gap_audit(spark, sf_dir):
    """G-08."""
    from causalgrid.operators import audits

    return audits.gap_audit(fx.grid_hourly(spark, sf_dir), HOURLY)


@query(
    with_views(
        "select zone, timestamp_utc, coalesce(temperature_c, case when rn - pi <= 3 then coalesce(p + (n - p) * (rn - pi) / (ni - pi), p) end) as temperature_c, "
        "coalesce(wind_speed_ms, wp) as wind_speed_ms from marked",
        "weather_obs",
        hours="""select zone, date_trunc('hour', timestamp_utc) as timestamp_utc, avg(temperature_c) as temperature_c, avg(wind_speed_ms) as wind_speed_ms
                 from weather_obs group by 1, 2""",
        full_hours="""select s.zone, s.timestamp_utc, temperature_c, wind_speed_ms, row_number() over (partition by s.zone order by s.timestamp_utc) as rn
              from (select zone, unnest(generate_series(min(timestamp_utc), max(timestamp_utc), interval 1 hour)) as timestamp_utc from hours group by zone) s
              left join hours h on h.zone = s.zone and h.timestamp_utc = s.timestamp_utc""",
        marked=f"""select *, last_value(temperature_c ignore nulls) {_PREV} as p, first_value(temperature_c ignore nulls) {_NEXT} as n,
              max(case when temperature_c is not null then rn end) {_PREV} as pi, min(case when temperature_c is not null then rn end) {_NEXT} as ni,
              last_value(wind_speed_ms ignore nulls) {_PREV} as wp from full_hours""",
    ),
    doubles="temperature_c wind_speed_ms",
)
def fill_weather_gaps(spark, sf_dir):
    """W-12 with a limit of three hours, W-11 without limit, on a grid that is regular already."""
    hours = fx.weather_obs(spark, sf_dir).groupBy("zone", F.date_trunc("hour", "timestamp_utc").alias("timestamp_utc"))
    hours = hours.agg(F.avg("temperature_c").alias("temperature_c"), F.avg("wind_speed_ms").alias("wind_speed_ms"))
    full = regular.regularize(hours, HOURLY)
    return regular.fill_gaps(full, HOURLY, linear={"temperature_c": 3}, ffill={"wind_speed_ms": None})


@query(
    with_views(
        """select zone, timestamp_utc, arg_max(value, event_id) as value, count(*) as n from (
             select 'SE' || (user_id % 4 + 1)::varchar as zone, date_trunc('hour', ts) as timestamp_utc, event_id, value from events) group by 1, 2"""
    ),
    doubles="value",
)
def keep_last_per_hour(spark, sf_dir):
    """G-06."""
    e = _hour_copies(spark, sf_dir)
    n = e.groupBy("zone", "timestamp_utc").agg(F.count("*").alias("n"))
    kept = regular.keep_last(e, ["zone", "timestamp_utc"], ["event_id"]).drop("event_id")
    return kept.join(n, ["zone", "timestamp_utc"])


@query(
    with_views(
        """select zone, timestamp_utc, arg_min(value, event_id) as value, min(event_id) as event_id from (
             select 'SE' || (user_id % 4 + 1)::varchar as zone, date_trunc('hour', ts) as timestamp_utc, event_id, value from events) group by 1, 2"""
    ),
    doubles="value",
)
def keep_first_per_hour(spark, sf_dir):
    """G-05, over the union of two overlapping parts (U-01)."""
    e = _hour_copies(spark, sf_dir)
    parts = e.where(F.dayofmonth("timestamp_utc") <= 20).unionByName(e.where(F.dayofmonth("timestamp_utc") > 10))
    return regular.keep_first(parts, ["zone", "timestamp_utc"], ["event_id"])


def _hour_copies(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    zone = F.concat(F.lit("SE"), (F.col("user_id") % 4 + 1).cast("string")).alias("zone")
    return e.select(zone, F.date_trunc("hour", "ts").alias("timestamp_utc"), "event_id", "value")


@query(
    """select 'SE' || (user_id % 4 + 1)::varchar as zone, date_trunc('hour', ts) as timestamp_utc, sum(value) as load_mw,
              bool_or(value > 200) as is_anomaly from events group by 1, 2""",
    doubles="load_mw",
)
def resample_quarter_hours(spark, sf_dir):
    """Sub-hourly rows summed to hours before the calendar fill, which would drop them."""
    e = fx.table(spark, sf_dir, "events")
    zone = F.concat(F.lit("SE"), (F.col("user_id") % 4 + 1).cast("string")).alias("zone")
    at = F.timestamp_micros(F.unix_micros("ts") - F.pmod(F.unix_micros("ts"), F.lit(900_000_000))).alias("timestamp_utc")
    quarters = e.groupBy(zone, at).agg(F.sum("value").alias("load_mw"), F.bool_or(F.col("value") > 200).alias("is_anomaly"))
    return regular.resample(quarters, HOURLY, sums=["load_mw"], flags=["is_anomaly"])


def _frame(n):
    return f"over (partition by zone order by timestamp_utc rows between {n - 1} preceding and current row)"


def _roll_sql(column, n, stats, mp):
    agg = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max", "sum": "sum"}
    return ", ".join(
        f"case when count({column}) {_frame(n)} >= {mp} then {agg[s]}({column}) {_frame(n)} end as {s}_{n}" for s in stats
    )


@query(
    with_views(
        f"select zone, timestamp_utc, {_roll_sql('load_mw', 24, ['mean', 'std', 'min', 'max', 'sum'], 12)}, "
        f"{_roll_sql('load_mw', 168, ['mean', 'std', 'min', 'max', 'sum'], 84)} from grid_filled",
        "grid_hourly",
        **FILLED,
    ),
    doubles="mean_24 std_24 min_24 max_24 sum_24 mean_168 std_168 min_168 max_168 sum_168",
    digits=4,
)
def rolling_load(spark, sf_dir):
    """W-05 and W-06: trailing statistics that need half of their window."""
    grid = HOURLY.sized_for(WEEK - 1)
    halo = chunks.with_halo(filled_grid(spark, sf_dir).select("zone", "timestamp_utc", "load_mw"), grid, WEEK - 1)
    specs = [
        Rolling("load_mw", n, s, f"{s}_{n}", min_periods(n)) for n in (24, WEEK) for s in ("mean", "std", "min", "max", "sum")
    ]
    return chunks.home_rows(rolling(halo, grid, specs)).drop("load_mw")


def daily_filled(spark, sf_dir):
    return regular.regularize(
        fx.grid_daily(spark, sf_dir), DAILY, linear={"load_mw": 6}, ffill={"imbalance_mwh": 6, "price_eur_mwh": 6}
    )


@query(
    with_views(
        """select zone, timestamp_utc, load_mw, load_mw - lag(load_mw, 90) over w as quarter_delta, load_mw - lag(load_mw, 365) over w as year_delta
           from daily_filled window w as (partition by zone order by timestamp_utc)""",
        "grid_daily",
        **FILLED_DAILY,
    ),
    doubles="load_mw quarter_delta year_delta",
    digits=4,
)
def long_shifts(spark, sf_dir):
    """W-08 at daily grain: a quarter and a year back, through a halo."""
    grid = DAILY.sized_for(365)
    halo = chunks.with_halo(daily_filled(spark, sf_dir).select("zone", "timestamp_utc", "load_mw"), grid, 365)
    w = grid.window()
    load = F.col("load_mw")
    out = halo.withColumns({"quarter_delta": load - F.lag(load, 90).over(w), "year_delta": load - F.lag(load, 365).over(w)})
    return chunks.home_rows(out)

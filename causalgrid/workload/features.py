"""Queries for features, each against SQL windows over the same aligned table."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from causalgrid.operators import audits, chunks, regular, validate
from causalgrid.operators.chunks import Grid
from causalgrid.operators.rolling import rolling
from causalgrid.plans import gold, silver
from causalgrid.plans.gold import FeatureConfig
from causalgrid.session import materialize
from causalgrid.workload import fixtures as fx
from causalgrid.workload.fixtures import with_views
from causalgrid.workload.joins import (
    DAILY_INPUTS,
    DAILY_VIEWS,
    HOURLY_INPUTS,
    SILVER_VIEWS,
    silver_daily,
    silver_hourly,
)
from causalgrid.workload.registry import query
from causalgrid.workload.series import DAILY, FILLED, HOURLY, filled_grid

HOURS = FeatureConfig()
# the daily table covers years: look-backs of a quarter and a year in days
DAYS = FeatureConfig(week=7, quarter=90, year=365, rate_lookbacks=(90, 180, 365), hydro_weeks=(1, 4, 12))

_W = "over (partition by zone order by timestamp_utc)"


def _frame(n: int) -> str:
    return f"over (partition by zone order by timestamp_utc rows between {n - 1} preceding and current row)"


CLEAN = """*, case when not is_quarantined then load_mw end as load_mw_clean,
        case when not is_quarantined then imbalance_mwh end as imbalance_mwh_clean"""

_HOLIDAYS = ", ".join(f"date '{d}'" for d in gold.HOLIDAYS)


def calendar_sql() -> dict[str, str]:
    t = "timestamp_utc"
    out = {
        "hour_of_day": f"hour({t})::int",
        "day_of_week": f"(isodow({t}) - 1)::int",
        "day_of_year": f"dayofyear({t})::int",
        "week_of_year": f"weekofyear({t})::int",
        "month": f"month({t})::int",
        "quarter": f"quarter({t})::int",
        "year": f"year({t})::int",
        "is_weekend": f"(isodow({t}) >= 6)::int",
        "is_swedish_holiday": f"({t}::date in ({_HOLIDAYS}))::int",
        "is_winter_peak_tariff": f"(month({t}) in (11, 12, 1, 2, 3) and hour({t}) between 7 and 20 and isodow({t}) < 6)::int",
        "is_midsommar_period": f"(month({t}) = 6 and dayofyear({t}) between 169 and 173)::int",
    }
    for n, x, p in (("hour", f"hour({t})", 24.0), ("dow", f"(isodow({t}) - 1)", 7.0), ("month", f"(month({t}) - 1)", 12.0), ("doy", f"dayofyear({t})", 365.0)):
        out[f"{n}_sin"] = f"sin({2 * math.pi!r}::double * {x} / {p}::double)"
        out[f"{n}_cos"] = f"cos({2 * math.pi!r}::double * {x} / {p}::double)"
    return out


def lag_sql(cfg: FeatureConfig) -> dict[str, str]:
    out = {f"load_mw_lag_{k}h": f"lag(load_mw_clean, {k}) {_W}" for k in cfg.load_lags}
    out |= {f"imbalance_mwh_lag_{k}h": f"lag(imbalance_mwh_clean, {k}) {_W}" for k in cfg.imbalance_lags}
    out |= {f"price_eur_mwh_lag_{k}h": f"lag(price_eur_mwh, {k}) {_W}" for k in cfg.price_lags}
    for c in ("imbalance_mwh", "load_mw"):
        out[f"{c}_diff_1h"] = f"{c}_clean - lag({c}_clean, 1) {_W}"
        out[f"{c}_diff_24h"] = f"{c}_clean - lag({c}_clean, {cfg.day}) {_W}"
    return out


_AGG = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max", "sum": "sum"}


def spec_sql(specs) -> dict[str, str]:
    return {
        s.name: f"case when count({s.column}) {_frame(s.width)} >= {s.min_count} then {_AGG[s.stat]}({s.column}) {_frame(s.width)} end"
        for s in specs
    }


DERIVED = {
    "price_eur_mwh_dev_24h": "price_eur_mwh - price_eur_mwh_roll_mean_24h",
    "imbalance_weekly_vs_monthly_ratio": "imbalance_mwh_roll_mean_168h / nullif(imbalance_mwh_roll_mean_720h, 0)",
    "load_mw_cv_24h": "load_mw_roll_std_24h / nullif(load_mw_roll_mean_24h, 0)",
    "imbalance_mwh_zscore_24h": "(imbalance_mwh_clean - imbalance_mwh_roll_mean_24h) / nullif(imbalance_mwh_roll_std_24h, 0)",
}


def shift_sql(cfg: FeatureConfig) -> dict[str, str]:
    out = {"x_load_year": f"lag(load_mw_clean, {cfg.year}) {_W}", "x_rate_1": f"lag(riksbank_policy_rate_pct, 1) {_W}"}
    for c in ("smahus_construction_index", "smahus_price_index"):
        out[f"x_q_{c}"] = f"lag({c}, {cfg.quarter}) {_W}"
    for i, k in enumerate(cfg.rate_lookbacks):
        out[f"x_rate_back_{i}"] = f"lag(riksbank_policy_rate_pct, {k}) {_W}"
    out["x_changed"] = f"riksbank_policy_rate_pct is distinct from lag(riksbank_policy_rate_pct) {_W}"
    return out


HOUSING = {
    "smahus_construction_qoq_delta": "smahus_construction_index - x_q_smahus_construction_index",
    "smahus_construction_qoq_pct": "(smahus_construction_index - x_q_smahus_construction_index) / nullif(x_q_smahus_construction_index, 0) * 100",
    "smahus_price_qoq_delta": "smahus_price_index - x_q_smahus_price_index",
    "smahus_price_qoq_pct": "(smahus_price_index - x_q_smahus_price_index) / nullif(x_q_smahus_price_index, 0) * 100",
    "seasonal_temp_proxy": f"cos({2 * math.pi!r}::double * day_of_year / 365.0::double)",
    "winter_x_construction": "(month in (11, 12, 1, 2, 3))::int * smahus_construction_index",
    "seasonal_temp_proxy_x_construction": f"cos({2 * math.pi!r}::double * day_of_year / 365.0::double) * smahus_construction_index",
    "construction_x_holiday": "smahus_construction_index * is_swedish_holiday",
    "peak_tariff_x_construction": "smahus_construction_index * is_winter_peak_tariff",
    "load_mw_yoy_delta": "load_mw_clean - x_load_year",
    "rate_x_construction": "riksbank_policy_rate_pct * smahus_construction_index",
}
RATE = {
    "riksbank_rate_step_change": "riksbank_policy_rate_pct - x_rate_1",
    "riksbank_rate_delta_90d": "riksbank_policy_rate_pct - x_rate_back_0",
    "riksbank_rate_delta_180d": "riksbank_policy_rate_pct - x_rate_back_1",
    "riksbank_rate_cumulative_365d": "riksbank_policy_rate_pct - x_rate_back_2",
    "riksbank_rate_direction": "sign(riksbank_policy_rate_pct - x_rate_back_0)::double",
    "riksbank_rate_above_neutral": "(riksbank_policy_rate_pct > 2.5)::int::double",
    "riksbank_rate_persistence_hours": "case when riksbank_policy_rate_pct is not null then (row_number() over (partition by zone, x_run order by timestamp_utc) - 1)::double end",
    "riksbank_rate_x_imbalance_lag24h": "riksbank_policy_rate_pct * imbalance_mwh_lag_24h",
    "riksbank_rate_x_winter_peak": "riksbank_policy_rate_pct * is_winter_peak_tariff",
}


def _diffs(c: str, name: str, day: int) -> dict[str, str]:
    return {f"{name}_diff_1h": f"{c} - lag({c}, 1) {_W}", f"{name}_diff_24h": f"{c} - lag({c}, {day}) {_W}"}


def outage_sql(cfg):
    return {
        "nuclear_outage_vs_demand_ratio": "outage_mw / nullif(load_mw_clean, 0)",
        "is_major_nuclear_outage": "coalesce(outage_mw > 1000, false)::int",
        **_diffs("outage_mw", "outage_mw", cfg.day),
    }


_STRESS = "abs(scheduled_net_position_mw) / (case when wind_speed_ms is not null then 1 + greatest(wind_speed_ms, 0) end)"


def flow_sql(cfg):
    return {
        "scheduled_flow_stress_abs": "abs(scheduled_net_position_mw)",
        "scheduled_flow_stress_metric": _STRESS,
        "scheduled_flow_stress_x_seasonal": f"{_STRESS} * (1 + 0.5 * -cos({2 * math.pi!r}::double * (day_of_year - 1) / 365.0::double))",
        **_diffs("scheduled_net_position_mw", "net_position", cfg.day),
    }


def hydro_sql(cfg):
    back = {n: f"reservoir_fill_ratio - lag(reservoir_fill_ratio, {n * cfg.week}) {_W}" for n in cfg.hydro_weeks}
    speed, hydro = f"({back[1]})", "zone in ('SE1', 'SE2')"
    return {
        **{f"reservoir_fill_diff_{n}w": q for n, q in back.items()},
        "hydro_depletion_velocity": back[1],
        "hydro_depletion_x_imbalance_lag1h": f"case when {hydro} then {speed} * imbalance_mwh_lag_1h end",
        "hydro_depletion_x_imbalance_lag24h": f"case when {hydro} then {speed} * imbalance_mwh_lag_24h end",
        "is_hydro_crunch": f"case when {hydro} then coalesce(reservoir_fill_ratio < 0.25 and {speed} < -0.005, false)::int end",
    }


READY = f"""timestamp_utc >= min(timestamp_utc) over (partition by zone) + interval 24 hour and not is_quarantined and imbalance_mwh is not null"""


def _cols(exprs: dict[str, str]) -> str:
    return ", ".join(f"{q} as {n}" for n, q in exprs.items())


def gold_sql(base: str, cfg: FeatureConfig, market: dict[str, str], columns: list[str]) -> tuple[str, dict[str, str]]:
    """The body and the views that compute all features over the aligned view ``base``."""
    specs = gold.rolling_specs(cfg, ["imbalance_mwh_clean", "load_mw_clean", "price_eur_mwh"]) + gold.market_rolling_specs(cfg, columns)
    views = {
        "g_clean": f"select {CLEAN} from {base}",
        "g_calendar": f"select *, {_cols(calendar_sql())} from g_clean",
        "g_lags": f"select *, {_cols(lag_sql(cfg) | shift_sql(cfg) | spec_sql(specs))} from g_calendar",
        "g_runs": f"select *, sum(x_changed::int) {_W} as x_run from g_lags",
        "g_all": f"select *, {_cols(DERIVED | HOUSING | RATE | market)}, {READY} as feature_ready from g_runs",
    }
    names = [*columns, "load_mw_clean", "imbalance_mwh_clean", *calendar_sql(), *lag_sql(cfg), *[s.name for s in specs], *DERIVED, *HOUSING, *RATE, *market]
    plain = set(calendar_sql()) - {n for n in calendar_sql() if n.endswith(("_sin", "_cos"))}
    flags = {"timestamp_utc", "zone", "is_anomaly", "is_quarantined", "has_imputed_grid", "is_anomaly_weather", "active_unit_count", "is_major_nuclear_outage", "is_hydro_crunch"}
    out = [n if n in plain | flags else f"case when {n} is not null then greatest(least({n}, 1e9), -1e9) end as {n}" for n in names]
    return f"select {', '.join(out)}, feature_ready from g_all", views, [n for n in names if n not in plain | flags]


SILVER_COLUMNS = (
    "timestamp_utc zone load_mw imbalance_mwh price_eur_mwh smahus_construction_index smahus_price_index riksbank_policy_rate_pct "
    "is_anomaly is_quarantined has_imputed_grid"
).split()
HOURLY_EXTRA = "scheduled_net_position_mw temperature_c wind_speed_ms is_anomaly_weather outage_mw active_unit_count".split()

_body, _views, _doubles = gold_sql("silver_hourly", HOURS, outage_sql(HOURS) | flow_sql(HOURS), SILVER_COLUMNS + HOURLY_EXTRA)


def gold_hourly(spark, sf_dir):
    return gold.build_gold(materialize(silver_hourly(spark, sf_dir), "silver"), HOURS)


@query(with_views(_body, *HOURLY_INPUTS, **SILVER_VIEWS, **_views), doubles=" ".join(_doubles), digits=4)
def gold_with_market_features(spark, sf_dir):
    """All 98 features plus outage and flow features per (zone, hour): raw tables to model input."""
    return gold_hourly(spark, sf_dir)


_NOT = ", ".join(f"'{c}'" for c in sorted(gold.NOT_FEATURES))


@query(
    f"""select column_name as feature from (describe select * from ({with_views(_body, *HOURLY_INPUTS, **SILVER_VIEWS, **_views)}))
        where column_name not in ({_NOT})"""
)
def feature_names(spark, sf_dir):
    """P-20: the columns of a feature table that a model may use, with the aligned table's own ones left out."""
    names = gold.feature_columns(gold_hourly(spark, sf_dir))
    return spark.createDataFrame([(n,) for n in names], "feature string")


# Market features by the input they come from, and those of reservoir zones.
_MARKET = {
    "outage_mw": "outage_mw_diff_1h outage_mw_diff_24h outage_mw_roll_mean_24h outage_mw_roll_mean_168h nuclear_outage_vs_demand_ratio is_major_nuclear_outage",
    "scheduled_net_position_mw": "net_position_diff_1h net_position_diff_24h net_position_roll_mean_24h net_position_roll_mean_168h net_position_roll_std_24h "
    "net_position_roll_std_168h scheduled_flow_stress_abs scheduled_flow_stress_metric scheduled_flow_stress_x_seasonal",
    "reservoir_fill_ratio": "reservoir_fill_diff_1w reservoir_fill_diff_4w reservoir_fill_diff_12w reservoir_fill_roll_mean_4w reservoir_fill_roll_mean_12w "
    "hydro_depletion_velocity",
}
_BASIN = "hydro_depletion_x_imbalance_lag1h hydro_depletion_x_imbalance_lag24h is_hydro_crunch"


@query(
    with_views(
        f"""select zone, unnest(string_split('{" ".join(_MARKET.values())}', ' ')) as feature from (select distinct zone from grid_hourly)
            union all select zone, unnest(string_split('{_BASIN}', ' ')) from (select distinct zone from grid_hourly) where zone in ('SE1', 'SE2')""",
        "grid_hourly",
    )
)
def market_feature_names(spark, sf_dir):
    """P-21: the market features that each zone is expected to have."""
    zones = fx.grid_hourly(spark, sf_dir).select("zone").distinct()
    names = spark.createDataFrame([(z, gold.expected_market_features(z)) for z in ("SE1", "SE2", "SE3", "SE4")], "zone string, names array<string>")
    return zones.join(names, "zone").select("zone", F.explode("names").alias("feature"))


_body_d, _views_d, _doubles_d = gold_sql("silver_daily", DAYS, hydro_sql(DAYS), SILVER_COLUMNS + ["reservoir_fill_ratio"])


@query(with_views(_body_d, *DAILY_INPUTS, **DAILY_VIEWS, **_views_d), doubles=" ".join(_doubles_d), digits=4)
def gold_with_macro_features(spark, sf_dir):
    """All 98 features plus hydro features per (zone, day), over years of housing, rate and reservoir series."""
    return gold.build_gold(materialize(silver_daily(spark, sf_dir), "silver"), DAYS, DAILY)


# --- one query per kind of feature ------------------------------------------------------------

GRID_CLEAN = {**FILLED, "silver_grid": "select *, is_anomaly or (load_mw is null and imbalance_mwh is null) as is_quarantined from grid_filled",
              "g_clean": f"select {CLEAN} from silver_grid"}


def clean_grid(spark, sf_dir):
    return gold.mask_quarantined(validate.quarantine(filled_grid(spark, sf_dir)))


@query(
    with_views(f"select zone, timestamp_utc, {_cols(lag_sql(HOURS))} from g_clean", "grid_hourly", **GRID_CLEAN),
    doubles=" ".join(lag_sql(HOURS)),
)
def lag_features(spark, sf_dir):
    """W-01 to W-04."""
    grid = HOURLY.sized_for(168)
    halo = chunks.with_halo(clean_grid(spark, sf_dir), grid, 168)
    out = halo.withColumns(gold.lag_columns(HOURS, grid.window(), halo.columns))
    return chunks.home_rows(out).select("zone", "timestamp_utc", *lag_sql(HOURS))


_SPECS = gold.rolling_specs(HOURS, ["imbalance_mwh_clean", "load_mw_clean", "price_eur_mwh"])


@query(
    with_views(
        f"select zone, timestamp_utc, {', '.join(s.name for s in _SPECS)}, {_cols(DERIVED)} from g_rolled",
        "grid_hourly",
        **GRID_CLEAN,
        g_rolled=f"select *, {_cols(spec_sql(_SPECS))} from g_clean",
    ),
    doubles=" ".join([*[s.name for s in _SPECS], *DERIVED]),
    digits=4,
)
def rolling_features(spark, sf_dir):
    """W-05 to W-07: day, week and month statistics and what is derived from them."""
    grid = HOURLY.sized_for(719)
    halo = chunks.with_halo(clean_grid(spark, sf_dir), grid, 719)
    rolled = rolling(halo, grid, _SPECS)
    out = chunks.home_rows(rolled.withColumns(gold.derived_rolling_columns(rolled.columns)))
    return out.select("zone", "timestamp_utc", *[s.name for s in _SPECS], *DERIVED)


@query(
    f"""select event_id, timestamp_utc, {_cols(calendar_sql())} from (select event_id, ts + event_id * interval 5 hour as timestamp_utc from events)""",
    doubles=" ".join(n for n in calendar_sql() if n.endswith(("_sin", "_cos"))),
)
def calendar_features(spark, sf_dir):
    """W-16: over several years."""
    later = F.timestamp_add("HOUR", (F.col("event_id") * 5).cast("int"), F.col("ts")).alias("timestamp_utc")
    return gold.add_calendar(fx.table(spark, sf_dir, "events").select("event_id", later))


@query(
    with_views(f"select zone, timestamp_utc, {READY} as feature_ready from silver_grid", "grid_hourly", **GRID_CLEAN),
)
def feature_readiness(spark, sf_dir):
    """A-08: past the warm-up of the zone, sound, with a target."""
    base = validate.quarantine(filled_grid(spark, sf_dir))
    edges = gold.zone_edges(HOURLY.placed(base), HOURLY, None)
    joined = HOURLY.placed(base).join(edges, ["zone", chunks.CHUNK])
    return joined.select("zone", "timestamp_utc", gold.ready(HOURS, base.columns).alias("feature_ready"))


@query(
    with_views(
        f"""select zone, count(*) as n_rows, 100 * avg(ready::int) as feature_ready_pct, 100 * avg(is_quarantined::int) as is_quarantined_pct,
                   100 * avg(is_quarantined::int) > 5 as is_high from (select *, {READY} as ready from silver_grid) group by zone""",
        "grid_hourly",
        **GRID_CLEAN,
    ),
    doubles="feature_ready_pct is_quarantined_pct",
)
def readiness_rates(spark, sf_dir):
    """G-12: how many rows of a zone a model may use, and how many are quarantined."""
    base = validate.quarantine(filled_grid(spark, sf_dir))
    edges = gold.zone_edges(HOURLY.placed(base), HOURLY, None)
    joined = HOURLY.placed(base).join(edges, ["zone", chunks.CHUNK])
    return audits.flag_rates(joined.withColumn("feature_ready", gold.ready(HOURS, base.columns)), ["feature_ready", "is_quarantined"])


@query(
    with_views(
        """select zone, timestamp_utc, riksbank_policy_rate_pct,
                  case when riksbank_policy_rate_pct is not null then (row_number() over (partition by zone, run order by timestamp_utc) - 1) end as steps_in_force
           from (select *, sum(changed::int) over (partition by zone order by timestamp_utc) as run from (
             select *, riksbank_policy_rate_pct is distinct from lag(riksbank_policy_rate_pct) over (partition by zone order by timestamp_utc) as changed
             from (select g.zone, g.timestamp_utc, r.policy_rate_pct as riksbank_policy_rate_pct from daily_filled g
                   asof left join policy_rate r on g.timestamp_utc >= r.effective_date_utc)))""",
        "grid_daily",
        "policy_rate",
        **{k: DAILY_VIEWS[k] for k in ("daily_full", "daily_marked", "daily_filled")},
    ),
    doubles="riksbank_policy_rate_pct",
)
def rate_persistence(spark, sf_dir):
    """W-14: how long the rate has been in force; runs cross chunk borders by edge rows.

    The chunks are made short on purpose, so that most runs are longer than a chunk.
    """
    rate = "riksbank_policy_rate_pct"
    grid = Grid(step_seconds=DAILY.step_seconds, chunk_steps=16)
    days = regular.regularize(fx.grid_daily(spark, sf_dir).select("zone", "timestamp_utc"), DAILY)
    known = silver.align_policy_rate(days, fx.policy_rate(spark, sf_dir))
    edges = gold.zone_edges(grid.placed(known), grid, rate)
    out = gold.with_run_start(chunks.with_halo(known, grid, 1), edges, grid, rate)
    steps = F.when(F.col(rate).isNotNull(), F.col(chunks.POS) - F.col("_run_start")).alias("steps_in_force")
    return out.where(chunks.HOME).select("zone", "timestamp_utc", rate, steps)


FLAG_WARM = """
    select g.zone, g.timestamp_utc, load_mw_lag_24h, load_mw_roll_mean_24h, riksbank_policy_rate_pct, is_quarantined from (
        select *, lag(load_mw_clean, 24) over w as load_mw_lag_24h,
               case when count(load_mw_clean) over f >= 12 then avg(load_mw_clean) over f end as load_mw_roll_mean_24h
        from g_clean window w as (partition by zone order by timestamp_utc),
             f as (partition by zone order by timestamp_utc rows between 23 preceding and current row)) g
    asof left join shifted r on g.timestamp_utc >= r.effective_date_utc"""

SHIFTED_RATE = """
    select (date '2023-12-20' + ((year(effective_date_utc) - 1995) * 12 + month(effective_date_utc))::int)::timestamp as effective_date_utc,
           arg_max(policy_rate_pct, effective_date_utc) as riksbank_policy_rate_pct from policy_rate group by 1"""


@query(
    with_views("select * from out", "grid_hourly", "policy_rate", **GRID_CLEAN, shifted=SHIFTED_RATE, out=FLAG_WARM),
    doubles="load_mw_lag_24h load_mw_roll_mean_24h riksbank_policy_rate_pct",
)
def flagship(spark, sf_dir):
    """Events to hourly metrics, every hour present, the rate in force, quarantine, look-backs."""
    month = (F.year("effective_date_utc") - 1995) * 12 + F.month("effective_date_utc")
    day = F.date_add(F.lit("2023-12-20").cast("date"), month).cast("timestamp").alias("day")
    rates = fx.policy_rate(spark, sf_dir).groupBy(day).agg(F.max_by("policy_rate_pct", "effective_date_utc").alias("policy_rate_pct"))
    base = silver.hourly_base(fx.grid_hourly(spark, sf_dir))
    aligned = silver.align_policy_rate(base, rates.withColumnRenamed("day", "effective_date_utc"))
    clean = gold.mask_quarantined(validate.quarantine(aligned))
    grid = HOURLY.sized_for(24)
    halo = chunks.with_halo(clean, grid, 24)
    lagged = halo.withColumn("load_mw_lag_24h", F.lag("load_mw_clean", 24).over(grid.window()))
    specs = [s for s in _SPECS if s.name == "load_mw_roll_mean_24h"]
    return chunks.home_rows(rolling(lagged, grid, specs)).select(
        "zone", "timestamp_utc", "load_mw_lag_24h", "load_mw_roll_mean_24h", "riksbank_policy_rate_pct", "is_quarantined"
    )

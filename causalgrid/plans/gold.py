"""Feature rows: what a model may know about each (zone, hour).

Everything that looks back over a bounded number of hours is computed from one shuffle by
(zone, chunk of time) with a halo; run lengths and the start of each zone come from one row per
chunk. No task ever holds a whole zone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causalgrid.functions.numeric import CLIP_LOWER, CLIP_UPPER, ratio, sanitise
from causalgrid.operators import chunks
from causalgrid.operators.chunks import CHUNK, HOME, POS, Grid
from causalgrid.operators.rolling import Rolling, min_periods, rolling
from causalgrid.operators.validate import require_columns

# Public holidays that change the load.
HOLIDAYS = (
    "2024-01-01", "2024-01-06", "2024-03-29", "2024-04-01", "2024-05-01", "2024-05-09", "2024-05-19", "2024-06-06",
    "2024-06-21", "2024-11-01", "2024-12-25", "2024-12-26",
    "2025-01-01", "2025-01-06", "2025-04-18", "2025-04-21", "2025-05-01", "2025-05-29", "2025-06-06", "2025-06-20",
    "2025-11-01", "2025-12-25", "2025-12-26",
    "2026-01-01", "2026-01-06", "2026-04-03", "2026-04-06", "2026-05-01", "2026-05-14", "2026-06-05", "2026-06-06",
    "2026-06-19", "2026-10-31", "2026-12-25", "2026-12-26",
)

# Columns that are never features.
NOT_FEATURES = frozenset(
    "timestamp_utc zone year load_mw imbalance_mwh price_eur_mwh load_mw_clean imbalance_mwh_clean "
    "smahus_construction_index smahus_price_index riksbank_policy_rate_pct temperature_c wind_speed_ms "
    "quality_flag_temp quality_flag_wind is_anomaly is_anomaly_weather is_quarantined has_imputed_grid feature_ready "
    "direction resolution_minutes outage_mw active_unit_count scheduled_net_position_mw reservoir_fill_ratio".split()
)

# Zones with a reservoir basin; a rate above this is restrictive; outages above
# this many MW are major; a reservoir below this share and draining this fast per week is scarce.
HYDRO_ZONES = ("SE1", "SE2")
NEUTRAL_RATE_PCT = 2.5
MAJOR_OUTAGE_MW = 1_000.0
SCARCE_FILL, SCARCE_DRAIN = 0.25, -0.005


@dataclass(frozen=True)
class FeatureConfig:
    """Look-backs in grid steps (hours)."""

    load_lags: tuple[int, ...] = (1, 2, 3, 6, 12, 24, 48, 168)
    imbalance_lags: tuple[int, ...] = (1, 2, 3, 6, 12, 24, 48, 168)
    price_lags: tuple[int, ...] = (1, 24, 168)
    windows: tuple[int, ...] = (24, 168, 720)
    day: int = 24
    week: int = 168
    quarter: int = 2_190
    year: int = 8_760
    rate_lookbacks: tuple[int, int, int] = (2_160, 4_320, 8_760)
    outage_windows: tuple[int, ...] = (24, 168)
    position_windows: tuple[int, ...] = (24, 168)
    hydro_weeks: tuple[int, ...] = (1, 4, 12)
    known_share: float = 0.5
    warmup_hours: int = 24
    seasonal_sign: float = -1.0
    clip_lower: float = CLIP_LOWER
    clip_upper: float = CLIP_UPPER
    fill: float | None = None


def mask_quarantined(df: DataFrame) -> DataFrame:
    """Hide quarantined load and imbalance from every window; the price stays visible."""
    hidden = F.coalesce("is_quarantined", F.lit(False)) if "is_quarantined" in df.columns else F.lit(False)
    return df.withColumns({f"{c}_clean": F.when(~hidden, F.col(c)) for c in ("load_mw", "imbalance_mwh")})


# --- calendar ------------------------------------------------------------------------------


def calendar_columns(ts: str = "timestamp_utc") -> dict[str, Column]:
    """The 18 calendar features and the year, from the timestamp alone."""
    t = F.col(ts)
    hour, dow, doy, month = F.hour(t), F.weekday(t), F.dayofyear(t), F.month(t)
    weekend = dow >= 5
    holiday = F.to_date(t).isin(*[F.lit(d).cast("date") for d in HOLIDAYS])
    peak = month.isin(11, 12, 1, 2, 3) & hour.between(7, 20) & ~weekend
    midsummer = (month == 6) & doy.between(169, 173)
    turn = 2 * math.pi
    cycles = {
        "hour": (hour, 24.0),
        "dow": (dow, 7.0),
        "month": (month - 1, 12.0),
        "doy": (doy, 365.0),
    }
    out = {
        "hour_of_day": hour,
        "day_of_week": dow,
        "day_of_year": doy,
        "week_of_year": F.weekofyear(t),
        "month": month,
        "quarter": F.quarter(t),
        "year": F.year(t),
        "is_weekend": weekend.cast("int"),
        "is_swedish_holiday": holiday.cast("int"),
    }
    for name, (x, period) in cycles.items():
        out[f"{name}_sin"] = F.sin(F.lit(turn) * x / period)
        out[f"{name}_cos"] = F.cos(F.lit(turn) * x / period)
    out["is_winter_peak_tariff"] = peak.cast("int")
    out["is_midsommar_period"] = midsummer.cast("int")
    return out


def add_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_columns())


# --- look-backs ----------------------------------------------------------------------------


def lag_columns(cfg: FeatureConfig, w, columns: Sequence[str]) -> dict[str, Column]:
    load, imbalance, price = F.col("load_mw_clean"), F.col("imbalance_mwh_clean"), F.col("price_eur_mwh")
    out = {f"load_mw_lag_{k}h": F.lag(load, k).over(w) for k in cfg.load_lags}
    out |= {f"imbalance_mwh_lag_{k}h": F.lag(imbalance, k).over(w) for k in cfg.imbalance_lags}
    if "price_eur_mwh" in columns:
        out |= {f"price_eur_mwh_lag_{k}h": F.lag(price, k).over(w) for k in cfg.price_lags}
    for name, c in (("imbalance_mwh", imbalance), ("load_mw", load)):
        out[f"{name}_diff_1h"] = c - F.lag(c, 1).over(w)
        out[f"{name}_diff_24h"] = c - F.lag(c, cfg.day).over(w)
    return out


def shift_columns(cfg: FeatureConfig, w, columns: Sequence[str]) -> dict[str, Column]:
    """Values a quarter, a year, or a rate look-back ago, under names of their own."""
    out = {"_load_year": F.lag("load_mw_clean", cfg.year).over(w)}
    for c in ("smahus_construction_index", "smahus_price_index"):
        if c in columns:
            out[f"_q_{c}"] = F.lag(c, cfg.quarter).over(w)
    if "riksbank_policy_rate_pct" in columns:
        rate = F.col("riksbank_policy_rate_pct")
        out["_rate_1"] = F.lag(rate, 1).over(w)
        for k in cfg.rate_lookbacks:
            out[f"_rate_{k}"] = F.lag(rate, k).over(w)
    return out


def market_shift_columns(cfg: FeatureConfig, w, columns: Sequence[str]) -> dict[str, Column]:
    out = {}
    for source, name in (("outage_mw", "outage_mw"), ("scheduled_net_position_mw", "net_position")):
        if source in columns:
            c = F.col(source)
            out[f"{name}_diff_1h"] = c - F.lag(c, 1).over(w)
            out[f"{name}_diff_24h"] = c - F.lag(c, cfg.day).over(w)
    if "reservoir_fill_ratio" in columns:
        fill = F.col("reservoir_fill_ratio")
        for weeks in cfg.hydro_weeks:
            out[f"reservoir_fill_diff_{weeks}w"] = fill - F.lag(fill, weeks * cfg.week).over(w)
    return out


def rolling_specs(cfg: FeatureConfig, columns: Sequence[str]) -> list[Rolling]:
    wanted = [
        ("imbalance_mwh_clean", "imbalance_mwh", ("mean", "std", "min", "max", "sum")),
        ("load_mw_clean", "load_mw", ("mean", "std", "max", "min")),
        ("price_eur_mwh", "price_eur_mwh", ("mean", "std")),
    ]
    return [
        Rolling(c, n, stat, f"{label}_roll_{stat}_{n}h", min_periods(n, cfg.known_share))
        for n in cfg.windows
        for c, label, stats in wanted
        if c in columns
        for stat in stats
    ]


def market_rolling_specs(cfg: FeatureConfig, columns: Sequence[str]) -> list[Rolling]:
    out = []
    if "outage_mw" in columns:
        out += [Rolling("outage_mw", n, "mean", f"outage_mw_roll_mean_{n}h", min_periods(n, cfg.known_share)) for n in cfg.outage_windows]
    if "scheduled_net_position_mw" in columns:
        out += [
            Rolling("scheduled_net_position_mw", n, stat, f"net_position_roll_{stat}_{n}h", min_periods(n, cfg.known_share))
            for n in cfg.position_windows
            for stat in ("mean", "std")
        ]
    if "reservoir_fill_ratio" in columns:
        out += [
            Rolling("reservoir_fill_ratio", wk * cfg.week, "mean", f"reservoir_fill_roll_mean_{wk}w", min_periods(wk * cfg.week, cfg.known_share))
            for wk in cfg.hydro_weeks[1:]
        ]
    return out


# --- row-local features --------------------------------------------------------------------


def derived_rolling_columns(columns: Sequence[str]) -> dict[str, Column]:
    c = F.col
    out = {}
    if "price_eur_mwh_roll_mean_24h" in columns:
        out["price_eur_mwh_dev_24h"] = c("price_eur_mwh") - c("price_eur_mwh_roll_mean_24h")
    if {"imbalance_mwh_roll_mean_168h", "imbalance_mwh_roll_mean_720h"} <= set(columns):
        out["imbalance_weekly_vs_monthly_ratio"] = ratio(c("imbalance_mwh_roll_mean_168h"), c("imbalance_mwh_roll_mean_720h"))
    if "load_mw_roll_std_24h" in columns:
        out["load_mw_cv_24h"] = ratio(c("load_mw_roll_std_24h"), c("load_mw_roll_mean_24h"))
    if "imbalance_mwh_roll_std_24h" in columns:
        off = c("imbalance_mwh_clean") - c("imbalance_mwh_roll_mean_24h")
        out["imbalance_mwh_zscore_24h"] = ratio(off, c("imbalance_mwh_roll_std_24h"))
    return out


def housing_columns(columns: Sequence[str]) -> dict[str, Column]:
    c = F.col
    built, prices = "smahus_construction_index", "smahus_price_index"
    season = F.cos(F.lit(2 * math.pi) * c("day_of_year") / 365.0)
    winter = c("month").isin(11, 12, 1, 2, 3).cast("double")
    out = {}
    for source, name in ((built, "smahus_construction"), (prices, "smahus_price")):
        if source in columns:
            delta = c(source) - c(f"_q_{source}")
            out[f"{name}_qoq_delta"] = delta
            out[f"{name}_qoq_pct"] = ratio(delta, c(f"_q_{source}")) * 100.0
    out["seasonal_temp_proxy"] = season
    if built in columns:
        out["winter_x_construction"] = winter * c(built)
        out["seasonal_temp_proxy_x_construction"] = season * c(built)
        out["construction_x_holiday"] = c(built) * c("is_swedish_holiday")
        out["peak_tariff_x_construction"] = c(built) * c("is_winter_peak_tariff")
    out["load_mw_yoy_delta"] = c("load_mw_clean") - c("_load_year")
    if built in columns and "riksbank_policy_rate_pct" in columns:
        out["rate_x_construction"] = c("riksbank_policy_rate_pct") * c(built)
    return out


def rate_columns(cfg: FeatureConfig, columns: Sequence[str]) -> dict[str, Column]:
    if "riksbank_policy_rate_pct" not in columns:
        return {}
    rate = F.col("riksbank_policy_rate_pct")
    near, mid, far = (rate - F.col(f"_rate_{k}") for k in cfg.rate_lookbacks)
    return {
        "riksbank_rate_step_change": rate - F.col("_rate_1"),
        "riksbank_rate_delta_90d": near,
        "riksbank_rate_delta_180d": mid,
        "riksbank_rate_cumulative_365d": far,
        "riksbank_rate_direction": F.signum(near),
        "riksbank_rate_above_neutral": (rate > NEUTRAL_RATE_PCT).cast("double"),
        "riksbank_rate_persistence_hours": F.when(rate.isNotNull(), (F.col(POS) - F.col("_run_start")).cast("double")),
        "riksbank_rate_x_imbalance_lag24h": rate * F.col("imbalance_mwh_lag_24h"),
        "riksbank_rate_x_winter_peak": rate * F.col("is_winter_peak_tariff"),
    }


def market_columns(cfg: FeatureConfig, columns: Sequence[str]) -> dict[str, Column]:
    """Ratios, stress metrics and scarcity flags; hydro interactions only in hydro zones."""
    c = F.col
    out = {}
    if "outage_mw" in columns:
        out["nuclear_outage_vs_demand_ratio"] = ratio(c("outage_mw"), c("load_mw_clean"))
        out["is_major_nuclear_outage"] = F.coalesce(c("outage_mw") > MAJOR_OUTAGE_MW, F.lit(False)).cast("int")
    if "scheduled_net_position_mw" in columns:
        size = F.abs(c("scheduled_net_position_mw"))
        calm = F.when(c("wind_speed_ms").isNotNull(), 1.0 + F.greatest(c("wind_speed_ms"), F.lit(0.0))) if "wind_speed_ms" in columns else F.lit(1.0)
        stress = ratio(size, calm)
        if "day_of_year" in columns:
            season = cfg.seasonal_sign * F.cos(F.lit(2 * math.pi) * (c("day_of_year") - 1) / 365)
            boost = 1.0 + 0.5 * season
        else:
            cold = -c("temperature_c") / 20.0
            boost = 1.0 + 0.4 * F.when(cold.isNotNull(), F.greatest(F.least(cold, F.lit(2.0)), F.lit(-2.0)))
        out["scheduled_flow_stress_abs"] = size
        out["scheduled_flow_stress_metric"] = stress
        out["scheduled_flow_stress_x_seasonal"] = stress * boost
    if "reservoir_fill_ratio" in columns:
        speed = c("reservoir_fill_diff_1w")
        hydro = c("zone").isin(*HYDRO_ZONES)
        scarce = (c("reservoir_fill_ratio") < SCARCE_FILL) & (speed < SCARCE_DRAIN)
        out["hydro_depletion_velocity"] = speed
        out["hydro_depletion_x_imbalance_lag1h"] = F.when(hydro, speed * c("imbalance_mwh_lag_1h"))
        out["hydro_depletion_x_imbalance_lag24h"] = F.when(hydro, speed * c("imbalance_mwh_lag_24h"))
        out["is_hydro_crunch"] = F.when(hydro, F.coalesce(scarce, F.lit(False)).cast("int"))
    return out


#: Inputs that market features are made of.
MARKET_INPUTS = ("outage_mw", "scheduled_net_position_mw", "reservoir_fill_ratio")
#: Features that only zones with a reservoir basin have values of.
HYDRO_ZONE_FEATURES = ("hydro_depletion_x_imbalance_lag1h", "hydro_depletion_x_imbalance_lag24h", "is_hydro_crunch")


def expected_market_features(zone: str, cfg: FeatureConfig = FeatureConfig(), inputs: Sequence[str] = MARKET_INPUTS) -> list[str]:
    """Names of the market features that a zone has where these inputs exist, from what makes them."""
    columns = [*inputs, "day_of_year"]
    made = {*market_shift_columns(cfg, Grid().window(), columns), *(s.name for s in market_rolling_specs(cfg, columns)), *market_columns(cfg, columns)}
    return sorted(made - set(() if zone in HYDRO_ZONES else HYDRO_ZONE_FEATURES))


# --- unbounded look-backs, one row per chunk -------------------------------------------------


def zone_edges(placed: DataFrame, grid: Grid, value: str | None) -> DataFrame:
    """Per (key, chunk): first timestamp of the key and where the running value began before it.

    ``value`` is constant over long stretches. A change inside a chunk is seen by a window over
    the chunk; a change at its border by comparing the ends of neighbouring chunks.
    """
    at = [F.min(grid.ts).alias("_first_ts")]
    rows = placed.select(*grid.keys, CHUNK, POS, grid.ts, *([value] if value else []))
    per_key = Window.partitionBy(*grid.keys)
    if value is None:
        once = rows.groupBy(*grid.keys, CHUNK).agg(*at)
        return once.select(*grid.keys, CHUNK, F.min("_first_ts").over(per_key).alias("_zone_start"))
    inside = Window.partitionBy(*grid.keys, CHUNK).orderBy(POS)
    rows = rows.withColumn("_earlier", F.lag(POS).over(inside)).withColumn("_was", F.lag(value).over(inside))
    changed = F.col("_earlier").isNotNull() & ~F.col(value).eqNullSafe(F.col("_was"))
    ends = rows.groupBy(*grid.keys, CHUNK).agg(
        *at,
        F.min(POS).alias("_from"),
        F.min(F.struct(POS, value)).alias("_head"),
        F.max(F.struct(POS, value)).alias("_last"),
        F.max(F.when(changed, F.col(POS))).alias("_change"),
    )
    order = per_key.orderBy(CHUNK)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    previous = F.lag("_last").over(order)
    broken = previous.isNull() | ~F.col("_head")[value].eqNullSafe(previous[value])
    ends = ends.withColumn("_start", F.coalesce("_change", F.when(broken, F.col("_from"))))
    return ends.select(
        *grid.keys,
        CHUNK,
        F.min("_first_ts").over(per_key).alias("_zone_start"),
        F.last("_start", ignorenulls=True).over(before).alias("_run_before"),
    )


def run_start(value: str, w) -> Column:
    """Position at which the current run of equal values began."""
    previous = F.lag(value).over(w)
    begins = F.col(HOME) & (F.lag(POS).over(w).isNull() | ~F.col(value).eqNullSafe(previous))
    return F.when(begins, F.col(POS))


def with_run_start(halo: DataFrame, edges: DataFrame, grid: Grid, value: str) -> DataFrame:
    w = grid.window()
    joined = halo.join(edges, [*grid.keys, CHUNK], "left")
    marked = joined.withColumn("_begins", run_start(value, w))
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.withColumn("_run_start", F.coalesce(F.last("_begins", True).over(so_far), F.col("_run_before"))).drop("_begins")


def ready(cfg: FeatureConfig, columns: Sequence[str]) -> Column:
    """Past the warm-up of its zone, not quarantined, and with a target."""
    warm = F.col("timestamp_utc") >= F.timestamp_add("HOUR", F.lit(cfg.warmup_hours), F.col("_zone_start"))
    sound = ~F.coalesce("is_quarantined", F.lit(False)) if "is_quarantined" in columns else F.lit(True)
    return warm & sound & F.col("imbalance_mwh").isNotNull()


# --- the whole -----------------------------------------------------------------------------


def build_gold(silver: DataFrame, cfg: FeatureConfig = FeatureConfig(), grid: Grid = Grid(), market: bool | None = None) -> DataFrame:
    """Silver rows with all features. ``market=None`` adds market features if their inputs exist."""
    require_columns(silver, ["timestamp_utc", "zone", "load_mw", "imbalance_mwh"], "aligned table")
    has = set(silver.columns)
    with_market = bool({"outage_mw", "scheduled_net_position_mw", "reservoir_fill_ratio"} & has) if market is None else market
    rate = "riksbank_policy_rate_pct" if "riksbank_policy_rate_pct" in has else None

    base = mask_quarantined(silver)
    specs = rolling_specs(cfg, base.columns) + (market_rolling_specs(cfg, base.columns) if with_market else [])
    shifts = [*cfg.load_lags, *cfg.imbalance_lags, cfg.day, cfg.year, cfg.quarter, *cfg.rate_lookbacks, *[s.width - 1 for s in specs]]
    if with_market:
        shifts += [n * cfg.week for n in cfg.hydro_weeks]
    lookback = max(shifts)
    grid = grid.sized_for(lookback)
    w = grid.window()

    halo = chunks.with_halo(base, grid, lookback)
    edges = zone_edges(grid.placed(silver), grid, rate)
    if rate:
        df = with_run_start(halo, edges, grid, rate)
    else:
        df = halo.join(edges, [*grid.keys, CHUNK], "left")

    # every window copies whole rows: what can be computed later is not there yet
    df = rolling(df, grid, specs)
    looked_back = lag_columns(cfg, w, base.columns) | shift_columns(cfg, w, base.columns)
    if with_market:
        looked_back |= market_shift_columns(cfg, w, base.columns)
    df = add_calendar(df.withColumns(looked_back).where(F.col(HOME)))
    df = df.withColumns(derived_rolling_columns(df.columns) | housing_columns(df.columns) | rate_columns(cfg, base.columns))
    if with_market:
        df = df.withColumns(market_columns(cfg, df.columns))
    df = df.withColumn("feature_ready", ready(cfg, base.columns))
    helpers = [c for c in df.columns if c.startswith("_")]
    return sanitise(df.drop(*helpers), lower=cfg.clip_lower, upper=cfg.clip_upper, fill=cfg.fill)


def feature_columns(df: DataFrame, target: str = "imbalance_mwh") -> list[str]:
    """Every column a model may use, in a fixed order."""
    return sorted(c for c in df.columns if c not in NOT_FEATURES and c != target)

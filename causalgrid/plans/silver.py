"""Aligned rows: one per (zone, hour), every column as it was known at that hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from causalgrid import schemas
from causalgrid.functions import periods
from causalgrid.operators import asof, regular, rollup, validate
from causalgrid.operators.asof import Series
from causalgrid.operators.chunks import HOUR, Grid
from causalgrid.session import materialize

HOUSING = ("smahus_construction_index", "smahus_price_index")
RATE = "riksbank_policy_rate_pct"
WEATHER = ("temperature_c", "wind_speed_ms")
FILL = "reservoir_fill_ratio"
WEEK = 168


def hourly_base(
    metrics: DataFrame, grid: Grid = Grid(), max_gap: int = 6, load_method: str = "linear", order: Sequence[str] = ()
) -> DataFrame:
    """One row per hour, complete from first to last, short gaps filled.

    Of several rows the last by the columns in ``order`` wins (an ingest time, say), which are
    not kept; equal ones are settled by their values.

    ``load_method="linear"`` draws a line to the next observation; ``"ffill"`` looks back only.
    """
    validate.require_columns(metrics, [*grid.keys, grid.ts], "hourly metrics")
    if "is_anomaly" not in metrics.columns:
        metrics = metrics.withColumn("is_anomaly", F.lit(False))
    held = {c: max_gap for c in ("imbalance_mwh", "price_eur_mwh") if c in metrics.columns}
    load = {"load_mw": max_gap} if "load_mw" in metrics.columns else {}
    linear, ffill = (load, held) if load_method == "linear" else ({}, {**load, **held})
    single = regular.keep_last(metrics, [*grid.keys, grid.ts], list(order)).drop(*order)
    return regular.regularize(
        single, grid, linear=linear, ffill=ffill, flags=["is_anomaly"], imputed_from="load_mw" if load else None
    )


def align_housing(hourly: DataFrame, quarterly: DataFrame) -> DataFrame:
    return asof.asof_join(hourly, _housing(quarterly))


def _housing(quarterly: DataFrame) -> Series:
    columns = {c: F.lit(None).cast("double") for c in HOUSING if c not in quarterly.columns}
    known = quarterly.withColumns(columns) if columns else quarterly
    return Series(known.withColumnRenamed("bidding_zone", "zone"), "period_utc", HOUSING)


def align_policy_rate(hourly: DataFrame, rates: DataFrame) -> DataFrame:
    renamed = rates.select("effective_date_utc", F.col("policy_rate_pct").alias(RATE))
    return asof.asof_calendar(hourly, renamed, "effective_date_utc", [RATE])


def _positions(net_positions: DataFrame) -> Series:
    gated = net_positions.withColumn("_gate", periods.gate_closure(F.col("timestamp_utc")))
    return Series(gated, "_gate", ("scheduled_net_position_mw",), tiebreak=("timestamp_utc",))


def align_net_positions(hourly: DataFrame, net_positions: DataFrame, mode: str = "latest") -> DataFrame:
    """``latest``: the last position of the latest closed gate. ``delivery``: the position for
    this very hour, whose gate closed at noon of the day before."""
    if mode == "latest":
        return asof.asof_join(hourly, _positions(net_positions))
    if mode != "delivery":
        raise ValueError(f"mode must be latest or delivery, not {mode!r}")
    position = net_positions.select("zone", "timestamp_utc", "scheduled_net_position_mw")
    return hourly.join(position, ["zone", "timestamp_utc"], "left").select(*hourly.columns, "scheduled_net_position_mw")


def see_hydro(hourly: DataFrame, weekly: DataFrame) -> DataFrame:
    """The reservoir level of a week is seen from the Monday after it."""
    monday = periods.iso_monday(F.col("year"), F.col("week_of_year"))
    known = weekly.select(periods.published(monday).alias("_published"), FILL)
    return asof.asof_calendar(hourly, known, "_published", [FILL], drop_nulls=False)


def _steps(grid: Grid, hours: int) -> int:
    """Hours as whole steps of the grid."""
    return hours * HOUR // grid.step_seconds


def align_hydro(hourly: DataFrame, weekly: DataFrame, grid: Grid = Grid(), max_interpolated_weeks: int = 2) -> DataFrame:
    """As seen, with gaps drawn as lines for some weeks and held after that."""
    return regular.fill_gaps(see_hydro(hourly, weekly), grid, linear={FILL: _steps(grid, max_interpolated_weeks * WEEK)}, hold=[FILL])


def see_weather(hourly: DataFrame, weather: DataFrame) -> DataFrame:
    """Nearest observation within half an hour; no observation is no anomaly."""
    validate.require_columns(weather, ["zone", "timestamp_utc", "temperature_c", "wind_speed_ms", "is_anomaly"], "weather")
    settled = rollup.settle_weather(weather).withColumnRenamed("is_anomaly", "is_anomaly_weather")
    joined = asof.nearest_within(hourly, settled, [*WEATHER, "is_anomaly_weather"])
    return joined.withColumn("is_anomaly_weather", F.coalesce("is_anomaly_weather", F.lit(False)))


def align_weather(hourly: DataFrame, weather: DataFrame, grid: Grid = Grid(), max_gap: int = 3) -> DataFrame:
    """As seen, with short gaps interpolated."""
    return regular.fill_gaps(see_weather(hourly, weather), grid, linear={c: max_gap for c in WEATHER})


def align_outages(hourly: DataFrame, outages: DataFrame) -> DataFrame:
    """Hours without a message have nothing out of service."""
    keys = ["zone", "timestamp_utc"]
    total = outages.groupBy(*keys).agg(
        F.sum("outage_mw").alias("outage_mw"), F.sum("active_unit_count").cast("int").alias("active_unit_count")
    )
    joined = hourly.join(total, keys, "left")
    return joined.select(
        *hourly.columns,
        F.coalesce("outage_mw", F.lit(0.0)).alias("outage_mw"),
        F.coalesce("active_unit_count", F.lit(0)).alias("active_unit_count"),
    )


def build_silver(
    metrics: DataFrame,
    quarterly: DataFrame | None = None,
    rates: DataFrame | None = None,
    weather: DataFrame | None = None,
    outages: DataFrame | None = None,
    net_positions: DataFrame | None = None,
    hydro: DataFrame | None = None,
    grid: Grid = Grid(),
    load_method: str = "linear",
    order: Sequence[str] = (),
    max_weather_gap: int = 3,
    max_interpolated_weeks: int = 2,
    staged: bool = True,
) -> DataFrame:
    """All inputs on one grid. What is absent becomes NULL columns.

    Quarterly values and net positions share one shuffle, weather and outages another one by
    (zone, hour), the national series come from a calendar-sized map, and weather and reservoir
    gaps are filled in one pass. Each pass reads its input twice (rows and chunk edges);
    ``staged`` writes the tables between passes to the shared folder, so that nothing is
    computed twice and lost executors cost one pass at most.
    """
    def stage(df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name) if staged else df

    df = hourly_base(metrics, grid, load_method=load_method, order=order)
    zoned = []
    if quarterly is not None:
        zoned.append(_housing(quarterly))
    if net_positions is not None:
        zoned.append(_positions(net_positions))
    if zoned:
        df = asof.asof_join(stage(df, "silver-base"), zoned)
    if rates is not None:
        df = align_policy_rate(df, rates)
    if outages is not None:
        df = align_outages(df, outages)
    if weather is not None:
        df = see_weather(df, weather)
    if hydro is not None:
        df = see_hydro(df, hydro)
    gaps = {c: max_weather_gap for c in WEATHER} if weather is not None else {}
    if hydro is not None:
        gaps[FILL] = _steps(grid, max_interpolated_weeks * WEEK)
    if gaps:
        df = regular.fill_gaps(stage(df, "silver-seen"), grid, linear=gaps, hold=[FILL])
    df = validate.quarantine(df)
    # the columns every aligned table has come first, then what weather and market inputs added
    return schemas.conform(df, schemas.SILVER)

"""Queries for splits and metrics, with the value a day earlier as the prediction."""

from __future__ import annotations

from pyspark.sql import functions as F

from causalgrid.operators import chunks, metrics, split
from causalgrid.operators.rolling import Rolling, rolling
from causalgrid.workload import fixtures as fx
from causalgrid.workload.fixtures import table, with_views
from causalgrid.workload.registry import query
from causalgrid.workload.series import FILLED, HOURLY, filled_grid

PREDICTED = """
    select zone, timestamp_utc, imbalance_mwh as y, lag(imbalance_mwh, 24) over (partition by zone order by timestamp_utc) as y_pred from grid_filled"""
RESIDUALS = "select *, y_pred - y as error, abs(y_pred - y) as abs_error from predicted where y is not null and y_pred is not null"
SCORED = {**FILLED, "predicted": PREDICTED, "residuals": RESIDUALS}


def predicted(spark, sf_dir):
    grid = HOURLY.sized_for(24)
    halo = chunks.with_halo(filled_grid(spark, sf_dir).select("zone", "timestamp_utc", F.col("imbalance_mwh").alias("y")), grid, 24)
    return chunks.home_rows(halo.withColumn("y_pred", F.lag("y", 24).over(grid.window())))


def residuals(spark, sf_dir):
    known = predicted(spark, sf_dir).where("y is not null and y_pred is not null")
    return metrics.with_errors(known)


_METRICS = """
    count(*) as n_test, avg(abs_error) as mae, sqrt(avg(error * error)) as rmse, avg(case when abs(y) > 1 then abs_error / abs(y) end) * 100 as mape_pct,
    1 - sum(error * error) / (var_pop(y) * count(*)) as r2, avg(error) as bias, max(abs_error) as max_error,
    quantile_cont(abs_error, 0.5) as medae, quantile_cont(abs_error, 0.9) as p90_error, quantile_cont(abs_error, 0.5) as p50_error"""
_METRIC_NAMES = "mae rmse mape_pct r2 bias max_error medae p90_error p50_error"


@query(with_views(f"select zone, {_METRICS} from residuals group by zone", "grid_hourly", **SCORED), doubles=_METRIC_NAMES, digits=5)
def forecast_metrics(spark, sf_dir):
    """G-13 over whole zones, quantiles by splitters."""
    return metrics.regression_metrics(predicted(spark, sf_dir))


_SLICE = """select * from (select *, row_number() over (partition by zone order by timestamp_utc desc) as rk from predicted) where rk <= 168"""


@query(
    with_views(
        f"""select m.*, b.* exclude (zone), (b.baseline_mae - m.mae) / b.baseline_mae * 100 as mae_improvement_pct
        from (select zone, {_METRICS} from (select *, y_pred - y as error, abs(y_pred - y) as abs_error from test_slice where y is not null and y_pred is not null)
              group by zone) m
        join (select zone, avg(abs(e)) as baseline_mae, sqrt(avg(e * e)) as baseline_rmse, quantile_cont(abs(e), 0.5) as baseline_medae,
                     1 - sum(e * e) / (var_pop(y) * count(*)) as baseline_r2, quantile_cont(abs(e), 0.9) as baseline_p90
              from (select zone, y, lag(y, 24) over (partition by zone order by timestamp_utc) - y as e from test_slice)
              where y is not null and e is not null group by zone) b using (zone)""",
        "grid_hourly",
        **SCORED,
        test_slice=_SLICE,
    ),
    doubles=_METRIC_NAMES + " baseline_mae baseline_rmse baseline_medae baseline_r2 baseline_p90 mae_improvement_pct",
    digits=5,
)
def baseline_comparison(spark, sf_dir):
    """G-14: a test slice against persistence within it."""
    test = metrics.latest(predicted(spark, sf_dir), 168)
    return metrics.improvement(metrics.regression_metrics(test, bounded=True), metrics.baseline_metrics(test))


@query(
    with_views(
        """select zone, m as mean, sqrt(avg(pow(error - m, 2))) as std, avg(pow(error - m, 3)) / pow(avg(pow(error - m, 2)), 1.5) as skew,
                  avg(pow(error - m, 4)) / pow(avg(pow(error - m, 2)), 2) - 3 as kurtosis
           from (select zone, error, avg(error) over (partition by zone) as m from residuals) group by zone, m""",
        "grid_hourly",
        **SCORED,
    ),
    doubles="mean std skew kurtosis",
    digits=5,
)
def residual_summary(spark, sf_dir):
    """G-15."""
    return metrics.residual_summary(residuals(spark, sf_dir))


@query(
    with_views(
        """select zone, bin, lo + bin * (hi - lo) / n_bins as bin_from, n_bins, count(*) as n from (
             select *, least(floor(coalesce((error - lo) / nullif(hi - lo, 0), 0) * n_bins), n_bins - 1)::int as bin from (
               select zone, error, min(error) over w as lo, max(error) over w as hi, least(80, greatest(20, count(*) over w // 200))::int as n_bins
               from residuals window w as (partition by zone))) group by zone, bin, lo, hi, n_bins""",
        "grid_hourly",
        **SCORED,
    ),
    doubles="bin_from",
    digits=4,
)
def residual_histogram(spark, sf_dir):
    """G-16."""
    return metrics.residual_histogram(residuals(spark, sf_dir))


_POINTS = ", ".join(f"{(i - 0.3175) / (199 + 0.365)!r}" for i in range(1, 200))


@query(
    with_views(
        f"""select zone, i::int as rank, q[i + 1] as observed
            from (select zone, quantile_cont(error, [{_POINTS}]) as q from residuals group by zone), range(0, 199) as r(i)""",
        "grid_hourly",
        **SCORED,
    ),
    doubles="observed",
    digits=4,
)
def residual_qq_points(spark, sf_dir):
    """G-17: exact quantiles; a test compares the theoretical side."""
    return metrics.qq_points(residuals(spark, sf_dir)).select("zone", F.col("rank").cast("int").alias("rank"), "observed")


@query(
    with_views(
        """select zone, timestamp_utc, case when count(abs_error) over f >= 84 then avg(abs_error) over f end as rolling_mae
           from (select *, abs(y_pred - y) as abs_error from predicted)
           window f as (partition by zone order by timestamp_utc rows between 167 preceding and current row)""",
        "grid_hourly",
        **SCORED,
    ),
    doubles="rolling_mae",
)
def rolling_error(spark, sf_dir):
    """W-22."""
    grid = HOURLY.sized_for(167)
    halo = chunks.with_halo(metrics.with_errors(predicted(spark, sf_dir)), grid, 167)
    out = rolling(halo, grid, [Rolling("abs_error", 168, "mean", "rolling_mae", 84)])
    return chunks.home_rows(out).select("zone", "timestamp_utc", "rolling_mae")


@query(
    """select "rank", feature, gain, gain / sum(gain) over () * 100 as gain_pct,
              sum(gain) over (order by "rank") / sum(gain) over () * 100 as cum_pct,
              case when feature like 'load_mw_lag%' then 'lags and rolling' when feature like 'riksbank_rate%' then 'policy rate'
                   when feature like 'smahus%' then 'housing' else 'calendar and other' end as feature_class
       from (select *, row_number() over (order by gain desc, feature) as "rank" from (
         select case p_size % 4 when 0 then 'load_mw_lag_' when 1 then 'riksbank_rate_' when 2 then 'smahus_' else 'hour_' end || p_size as feature,
                sum(p_retailprice) as gain from part group by 1)) where "rank" <= 30""",
    doubles="gain gain_pct cum_pct",
    digits=4,
)
def importance_shares(spark, sf_dir):
    """G-18, T-03 and P-26: the thirty strongest features."""
    kind = F.col("p_size") % 4
    name = F.when(kind == 0, "load_mw_lag_").when(kind == 1, "riksbank_rate_").when(kind == 2, "smahus_").otherwise("hour_")
    gains = table(spark, sf_dir, "part").groupBy(F.concat(name, F.col("p_size").cast("string")).alias("feature"))
    return metrics.importance_table(gains.agg(F.sum("p_retailprice").alias("gain")), top=30)


INDEXED = "select zone, timestamp_utc, row_number() over (partition by zone order by timestamp_utc) - 1 as i, count(*) over (partition by zone) as n from grid_hourly"


@query(
    with_views(
        "select zone, timestamp_utc, i as row_index, n as n_rows, case when i >= n - 72 then 'test' else 'train' end as split from indexed",
        "grid_hourly",
        indexed=INDEXED,
    )
)
def train_test_split(spark, sf_dir):
    """M-01."""
    g = fx.grid_hourly(spark, sf_dir).select("zone", "timestamp_utc")
    return split.temporal_split(g, 72, HOURLY)


@query(
    with_views(
        """select zone, timestamp_utc, fold, case when i >= s and i < s + t then 'test' else 'train' end as role
           from (select *, n // 6 as t, n - (6 - fold) * (n // 6) as s from indexed, (select unnest([1, 2, 3, 4, 5])::int as fold) folds)
           where (i >= s and i < s + t) or i < s - 24""",
        "grid_hourly",
        indexed=INDEXED,
    )
)
def walk_forward_folds(spark, sf_dir):
    """M-02: five expanding folds with a gap."""
    indexed = split.with_row_index(fx.grid_hourly(spark, sf_dir).select("zone", "timestamp_utc"), HOURLY)
    return split.walk_forward(indexed, 5, 24).select("zone", "timestamp_utc", "fold", "role")


@query(
    with_views(
        "select zone, timestamp_utc, i >= n - greatest(1, floor(n * 0.1)) as watches from indexed",
        "grid_hourly",
        indexed=INDEXED,
    )
)
def early_stop_rows(spark, sf_dir):
    """M-03."""
    indexed = split.with_row_index(fx.grid_hourly(spark, sf_dir).select("zone", "timestamp_utc"), HOURLY)
    watches = split.early_stop_slice(F.col(split.INDEX), F.col(split.TOTAL)).alias("watches")
    return indexed.select("zone", "timestamp_utc", watches)


@query(
    with_views(
        """select zone, count(*) as n_folds, avg(mae) as mean_mae, stddev_pop(mae) as std_mae, avg(rmse) as mean_rmse, stddev_pop(rmse) as std_rmse from (
             select zone, day(timestamp_utc) // 7 as fold, avg(abs_error) as mae, sqrt(avg(error * error)) as rmse from residuals group by 1, 2) group by 1""",
        "grid_hourly",
        **SCORED,
    ),
    doubles="mean_mae std_mae mean_rmse std_rmse",
)
def cross_validation_summary(spark, sf_dir):
    """G-21: mean and population deviation over folds, here weeks."""
    r = residuals(spark, sf_dir).withColumn("fold", F.floor(F.dayofmonth("timestamp_utc") / 7))
    folds = r.groupBy("zone", "fold").agg(F.avg("abs_error").alias("mae"), F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"))
    return metrics.cv_summary(folds)

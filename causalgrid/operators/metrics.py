"""How good predictions are, per zone."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causalgrid.functions import labels
from causalgrid.operators.keys import null_safe_join, with_facts
from causalgrid.operators.quantiles import exact_quantiles

ERROR_QUANTILES = {"medae": 0.5, "p90_error": 0.9, "p50_error": 0.5}


def with_errors(df: DataFrame, y: str = "y", pred: str = "y_pred") -> DataFrame:
    return df.withColumn("error", F.col(pred) - F.col(y)).withColumn("abs_error", F.abs(F.col(pred) - F.col(y)))


def regression_metrics(df: DataFrame, y: str = "y", pred: str = "y_pred", by: Sequence[str] = ("zone",), bounded: bool = False) -> DataFrame:
    """Counts, means, R², bias and exact error quantiles in one row per key.

    ``bounded=True`` says that a key has few rows (a test slice of some hundred hours): quantiles
    are then plain aggregates. Otherwise they are found by ``exact_quantiles``.
    """
    by = list(by)
    rows = with_errors(df.where(F.col(y).isNotNull() & F.col(pred).isNotNull()), y, pred)
    e, a, t = F.col("error"), F.col("abs_error"), F.col(y)
    relative = F.when(F.abs(t) > 1.0, a / F.abs(t))
    # var_pop merges centred moments, which keeps R² accurate for any level of y
    r2 = F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(t) * F.count("*"))
    plain = [
        F.count("*").alias("n_test"),
        F.avg(a).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(relative) * 100).alias("mape_pct"),
        r2.alias("r2"),
        F.avg(e).alias("bias"),
        F.max(a).alias("max_error"),
    ]
    if bounded:
        return rows.groupBy(*by).agg(*plain, *[F.percentile("abs_error", q).alias(n) for n, q in ERROR_QUANTILES.items()])
    return null_safe_join(rows.groupBy(*by).agg(*plain), exact_quantiles(rows, "abs_error", ERROR_QUANTILES, by), by, "left")


def baseline_metrics(test: DataFrame, y: str = "y", lag: int = 24, by: Sequence[str] = ("zone",)) -> DataFrame:
    """Persistence: the value a day earlier within the test slice; its first day has none.

    A test slice is some hundred rows per zone, so a window per zone is bounded.
    """
    w = Window.partitionBy(*by).orderBy("timestamp_utc")
    shifted = test.withColumn("_base", F.lag(y, lag).over(w))
    m = regression_metrics(shifted, y, "_base", by, bounded=True)
    return m.select(
        *by,
        F.col("mae").alias("baseline_mae"),
        F.col("rmse").alias("baseline_rmse"),
        F.col("medae").alias("baseline_medae"),
        F.col("r2").alias("baseline_r2"),
        F.col("p90_error").alias("baseline_p90"),
    )


def improvement(metrics: DataFrame, baseline: DataFrame, by: Sequence[str] = ("zone",)) -> DataFrame:
    gain = F.try_divide(F.col("baseline_mae") - F.col("mae"), F.col("baseline_mae")) * 100
    return null_safe_join(metrics, baseline, list(by), "left").withColumn("mae_improvement_pct", gain)


def residual_summary(df: DataFrame, by: Sequence[str] = ("zone",)) -> DataFrame:
    e = F.col("error")
    return df.groupBy(*by).agg(
        F.avg(e).alias("mean"), F.stddev_pop(e).alias("std"), F.skewness(e).alias("skew"), F.kurtosis(e).alias("kurtosis")
    )


def residual_histogram(df: DataFrame, by: Sequence[str] = ("zone",)) -> DataFrame:
    """Equal bins from least to greatest; their number grows with the rows, from 20 to 80.

    Each key's span is sent to the residuals where keys are few, so that only counts of bins are shuffled.
    """
    by = list(by)
    bins = F.least(F.lit(80), F.greatest(F.lit(20), F.floor(F.col("_n") / 200))).cast("int")
    span = df.groupBy(*by).agg(F.count("error").alias("_n"), F.min("error").alias("_lo"), F.max("error").alias("_hi"))
    span = span.select(*by, "_lo", "_hi", bins.alias("n_bins"))
    share = F.try_divide(F.col("error") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    index = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * F.col("n_bins")), F.col("n_bins") - 1).cast("int")
    binned = with_facts(df.where(F.col("error").isNotNull()), span, by).withColumn("bin", index)
    left = F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / F.col("n_bins")
    return binned.groupBy(*by, "bin", left.alias("bin_from"), "n_bins").agg(F.count("*").alias("n"))


def qq_points(df: DataFrame, points: int = 199, by: Sequence[str] = ("zone",)) -> DataFrame:
    """Exact residual quantiles beside those of the normal distribution."""
    p = [(i - 0.3175) / (points + 0.365) for i in range(1, points + 1)]
    normal = [F.lit(NormalDist().inv_cdf(x)) for x in p]
    seen = exact_quantiles(df, "error", {f"_q{i}": x for i, x in enumerate(p)}, by)
    points_of = F.array(*[F.struct(n.alias("theoretical"), F.col(f"_q{i}").alias("observed")) for i, n in enumerate(normal)])
    both = seen.select(*by, F.posexplode(points_of).alias("rank", "_p"))
    return both.select(*by, "rank", "_p.theoretical", "_p.observed")


def importance_table(importances: DataFrame, top: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Share and running share of each feature's gain among the ``top`` ones, with its class.

    One row per feature and key: as many rows as the model has features.
    """
    order = Window.partitionBy(*by).orderBy(F.col("gain").desc(), "feature")
    ranked = importances.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    share = F.col("gain") / F.sum("gain").over(Window.partitionBy(*by)) * 100
    out = ranked.withColumn("gain_pct", share)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = out.withColumn("cum_pct", F.sum("gain_pct").over(so_far))
    return out.withColumn("feature_class", labels.feature_class(F.col("feature")))


def latest(df: DataFrame, n: int, by: Sequence[str] = ("zone",), ts: str = "timestamp_utc") -> DataFrame:
    """The last ``n`` rows per key; the limit is applied before the shuffle as well."""
    order = Window.partitionBy(*by).orderBy(F.col(ts).desc())
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def earliest(df: DataFrame, n: int, by: Sequence[str] = ("zone",), ts: str = "timestamp_utc") -> DataFrame:
    order = Window.partitionBy(*by).orderBy(ts)
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def outage_kpis(df: DataFrame) -> DataFrame:
    """Unavailable MW now, its peak over a day and a week of rows, active units, alert level."""
    order = Window.partitionBy("zone").orderBy(F.col("timestamp_utc").desc())
    week = df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= 168)
    now = F.col("_rank") == 1

    def at_end(c: str) -> Column:
        return F.max(F.when(now, F.col(c)))

    kpis = week.groupBy("zone").agg(
        at_end("outage_mw").alias("current_outage_mw"),
        F.max(F.when(F.col("_rank") <= 24, F.col("outage_mw"))).alias("peak_24h_mw"),
        F.max("outage_mw").alias("peak_168h_mw"),
        at_end("active_unit_count").alias("active_units"),
    )
    return kpis.withColumn("alert_level", labels.alert_level(F.col("current_outage_mw")))


def divergence(df: DataFrame) -> DataFrame:
    """How often contract and physics disagree, and how they correlate."""
    p, i = F.col("scheduled_net_position_mw"), F.col("imbalance_mwh")
    apart = F.coalesce(labels.diverges(p, i), F.lit(False)).cast("double")
    return df.groupBy("zone").agg((F.avg(apart) * 100).alias("diverging_pct"), F.corr(p, i).alias("correlation"))


def cv_summary(folds: DataFrame, by: Sequence[str] = ("zone",)) -> DataFrame:
    """Mean and population deviation of MAE and RMSE over folds."""
    return folds.groupBy(*by).agg(
        F.count("*").alias("n_folds"),
        *[f(m).alias(f"{n}_{m}") for m in ("mae", "rmse") for n, f in (("mean", F.avg), ("std", F.stddev_pop))],
    )

"""Training reports: what was fitted, how well, on what, as one nested row per zone and one across zones.

Every part is a small table with one row per zone, fold or feature; zones come from all of them, so one that failed is
reported with its reason instead of missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causalgrid.operators import metrics
from causalgrid.plans import training
from causalgrid.sources import sinks


def nested(df: DataFrame, name: str) -> DataFrame:
    """``zone`` and all other columns as one struct."""
    return df.select("zone", F.struct(*[c for c in df.columns if c != "zone"]).alias(name))


def fold_facts(folds: DataFrame) -> DataFrame:
    """``zone, cv``: errors in the order of folds, their mean and population deviation, and the folds that failed."""
    done = F.col("status") == "done"
    ordered = F.array_sort(F.collect_list(F.when(done, F.struct("fold", "mae", "rmse"))))
    broken = F.array_sort(F.collect_list(F.when(~done, F.struct("fold", "reason"))))
    facts = folds.groupBy("zone").agg(
        F.count_if(done).alias("n_folds"),
        *[f(F.when(done, F.col(m))).alias(f"{n}_{m}") for m in ("mae", "rmse") for n, f in (("mean", F.avg), ("std", F.stddev_pop))],
        ordered.alias("_f"),
        broken.alias("failed_folds"),
    )
    return nested(facts.withColumns({"fold_mae": F.col("_f.mae"), "fold_rmse": F.col("_f.rmse")}).drop("_f"), "cv")


def strongest(gains: DataFrame, top: int) -> DataFrame:
    """``zone, features``: the ``top`` features with their share of the gain, strongest first."""
    table = metrics.importance_table(gains, top, by=["zone"])
    ranked = F.array_sort(F.collect_list(F.struct("rank", "feature", "gain_pct")))
    names = F.transform(ranked, lambda x: F.struct(x["feature"].alias("feature"), x["gain_pct"].alias("gain_pct")))
    return table.groupBy("zone").agg(names.alias("features"))


def zone_reports(tested: DataFrame, folds: DataFrame, gains: DataFrame, provenance: DataFrame, top: int = 20) -> DataFrame:
    """``zone, test, cv, features, provenance``; a part that a zone does not have is NULL.

    ``tested`` has the metrics of each zone's held-out rows, ``folds`` one row per (zone, fold) with ``status, reason, mae, rmse``, ``gains``
    one per (zone, feature), ``provenance`` the status of each zone's fit, its rows and times.
    """
    out = nested(tested, "test")
    for part in (fold_facts(folds), strongest(gains, top), nested(provenance, "provenance")):
        out = out.join(part, "zone", "full")
    return out


def across_zones(reports: DataFrame) -> DataFrame:
    """One row over the zones' reports: how many were fitted, the mean errors, the best and worst zone, and what failed."""
    mae, status = F.col("test.mae"), F.col("provenance.status")
    failed: Column = F.when(~status.eqNullSafe("done"), F.struct("zone", F.col("provenance.reason").alias("reason")))
    return reports.agg(
        F.count("*").alias("n_zones"),
        F.count_if(status == "done").alias("n_trained"),
        F.avg(mae).alias("mean_mae"),
        F.avg("test.rmse").alias("mean_rmse"),
        F.avg("cv.mean_mae").alias("cv_mean_mae"),
        F.min(F.when(mae.isNotNull(), F.struct(mae.alias("mae"), "zone")))["zone"].alias("best_zone"),
        F.max(F.when(mae.isNotNull(), F.struct(mae.alias("mae"), "zone")))["zone"].alias("worst_zone"),
        F.array_sort(F.collect_list(failed)).alias("failed"),
    )


def run_reports(spark, run: training.Run, top: int = 20) -> DataFrame:
    """The zones' reports of a training run."""
    jobs = run.jobs(spark)
    facts = jobs.where(F.col("fold") == training.FINAL)
    provenance = facts.select("zone", "status", "reason", "train_rows", "test_rows", "train_from", "train_to", "fitted_trees", "kept_trees", "watch_error")
    provenance = provenance.withColumns({"n_features": F.lit(len(run.features)), "path": F.lit(run.path)})
    folds = jobs.where(F.col("fold") != training.FINAL).select("zone", "fold", "status", "reason", "mae", "rmse")
    return zone_reports(training.evaluate(spark, run), folds, training.importances(spark, run), provenance, top)


def write_reports(reports: DataFrame, path: str, batch: str) -> None:
    """JSON lines: one per zone, and one across zones beside them; a batch that is written again replaces its lines."""
    sinks.write_json(reports, f"{path}/zones", batch)
    sinks.write_json(across_zones(reports), f"{path}/summary", batch)

"""Queries that fit models, and those that walk, sum up and report forests and metrics made from the tables.

Learners differ in their numbers, so of the fits only the rows are compared; a given forest answers alike everywhere.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from causalgrid.operators import metrics
from causalgrid.plans import forest, report, training
from causalgrid.plans.training import TrainConfig
from causalgrid.session import materialize, scratch_path
from causalgrid.workload import fixtures as fx
from causalgrid.workload.features import gold_hourly
from causalgrid.workload.fixtures import table, with_views
from causalgrid.workload.registry import query
from causalgrid.workload.scoring import SCORED, predicted, residuals

#: A month of hours per zone: shorter slices and a faster rate than a year asks for; rows, features and the rule to stop are whole.
MONTH = TrainConfig(test_rows=72, folds=3, gap=24, trees=40, patience=5, learning_rate=0.3, depth=4, min_leaf_rows=10)


def gold_table(spark, sf_dir):
    """All features of all zones, stored once for all fits."""
    return materialize(gold_hourly(spark, sf_dir), "gold")


@query()
def zone_models(spark, sf_dir):
    """M-04 and M-06 to M-08: fit, store, load and evaluate a model per zone."""
    path = scratch_path(spark, "models")
    training.train_zones(gold_table(spark, sf_dir), MONTH, path=path)
    return training.evaluate(spark, training.load(spark, path))


@query()
def walk_forward_scores(spark, sf_dir):
    """M-05: a fit per zone and fold, a row each."""
    return training.walk_forward_scores(gold_table(spark, sf_dir), MONTH)


@query()
def feature_gains(spark, sf_dir):
    """M-09: gains per zone with their shares."""
    run = training.train_zones(gold_table(spark, sf_dir), MONTH)
    return metrics.importance_table(training.importances(spark, run), top=20, by=["zone"])


# --- a forest made from the tables ---------------------------------------------------------------------

FEATURES = ("load_mw", "imbalance_mwh", "price_eur_mwh")


def nation_forest(spark, sf_dir):
    """A tree per zone and nation: which columns it asks, and where it splits, come from the nation and the zone's means."""
    means = fx.grid_hourly(spark, sf_dir).groupBy("zone").agg(F.array(*[F.coalesce(F.avg(c), F.lit(0.0)) for c in FEATURES]).alias("means"))
    k = F.col("n_nationkey").cast("int")
    asked = [(k + i) % 3 for i in range(3)]
    at = [F.get("means", a) * (F.lit(0.8) + F.lit(0.1) * ((k + i) % 5)) for i, a in enumerate(asked)]
    leaf = [F.lit(0.0) + (k - 12) * (i + 1) for i in range(4)]
    none, zero = F.lit(-1), F.lit(0.0)
    # the root asks first, then its left child, then its right child; leaves from left to right
    columns = {
        "feature": (asked[0], asked[1], none, none, asked[2], none, none),
        "threshold": (at[0], at[1], zero, zero, at[2], zero, zero),
        "left": tuple(F.lit(x) for x in (1, 2, -1, -1, 5, -1, -1)),
        "right": tuple(F.lit(x) for x in (4, 3, -1, -1, 6, -1, -1)),
        "value": (zero, zero, leaf[0], leaf[1], zero, leaf[2], leaf[3]),
        "gain": (zero + k + 1, zero + k * 2, zero, zero, zero + 3, zero, zero),
    }
    zones = F.array(*[F.lit(f"SE{i}") for i in range(1, 5)])
    trees = table(spark, sf_dir, "nation").select("n_nationkey", F.explode(zones).alias("zone")).join(means, "zone")
    arrays = [F.array(*v).alias(n) for n, v in columns.items()]
    return trees.select("zone", k.alias("tree"), F.when(k == 0, 1.0).otherwise(0.1).alias("weight"), *arrays)


def _asks(i: int) -> str:
    """The tree's i-th question: true to the left."""
    x = "[coalesce(load_mw, {m}), coalesce(imbalance_mwh, {m}), coalesce(price_eur_mwh, {m})]".format(m=repr(training.MISSING))
    return f"({x})[(k + {i}) % 3 + 1] <= means[(k + {i}) % 3 + 1] * (0.8 + 0.1 * ((k + {i}) % 5))"


@query(
    with_views(
        f"""select zone, timestamp_utc, sum((case when k = 0 then 1.0 else 0.1 end)::double * (k - 12) * (case when {_asks(0)} then (case when {_asks(1)} then 1 else 2 end)
                   else (case when {_asks(2)} then 3 else 4 end) end)) as y_pred
            from grid_hourly join (select zone, [coalesce(avg(load_mw), 0), coalesce(avg(imbalance_mwh), 0), coalesce(avg(price_eur_mwh), 0)]::double[] as means
                                   from grid_hourly group by zone) using (zone), (select n_nationkey::int as k from nation)
            group by 1, 2""",
        "grid_hourly",
    ),
    doubles="y_pred",
    digits=4,
)
def forest_scores(spark, sf_dir):
    """M-07: all zones answered in one scan by the trees stored for them."""
    rows = fx.grid_hourly(spark, sf_dir).select("zone", "timestamp_utc", *FEATURES)
    return forest.predictions(rows, nation_forest(spark, sf_dir), FEATURES, training.MISSING).select("zone", "timestamp_utc", "y_pred")


@query(
    with_views(
        """select zone, feature, gain / sum(gain) over (partition by zone) as gain from (
             select zone, ['load_mw', 'imbalance_mwh', 'price_eur_mwh'][f + 1] as feature, sum(g)::double as gain from (
               select zone, unnest([k % 3, (k + 1) % 3, (k + 2) % 3]) as f, unnest([k + 1, k * 2, 3]) as g
               from (select distinct zone from grid_hourly), (select n_nationkey::int as k from nation)) group by 1, 2)""",
        "grid_hourly",
    ),
    doubles="gain",
)
def forest_gains(spark, sf_dir):
    """M-09: gains of a stored forest."""
    return forest.gains(nation_forest(spark, sf_dir), FEATURES)


# --- reports -------------------------------------------------------------------------------------------

_REPORT = """
    select r.zone, n_test, mae, rmse, bias, cv.n_folds, cv.mean_mae, cv.std_mae, cv.fold_mae, f.features, p.status, p.reason, p.train_rows
    from (select zone, count(*) as n_test, avg(abs_error) as mae, sqrt(avg(error * error)) as rmse, avg(error) as bias from residuals group by zone) r
    join (select zone, count(*) as n_folds, avg(mae) as mean_mae, stddev_pop(mae) as std_mae, list(round(mae + 1e-6, 3) order by fold) as fold_mae from folds
          where fold > 0 group by zone) cv using (zone)
    join (select zone, list(feature order by gain desc, feature) as features from (select *, row_number() over (partition by zone order by gain desc, feature) as k from gains)
          where k <= 5 group by zone) f using (zone)
    join provenance p using (zone)"""
_REPORTED = {
    **SCORED,
    "folds": "select zone, day(timestamp_utc) // 7 as fold, avg(abs_error) as mae from residuals group by 1, 2",
    "gains": """select 'SE' || (p_partkey % 4 + 1)::varchar as zone, 'load_mw_lag_' || p_size as feature, sum(p_retailprice) as gain from part group by 1, 2""",
    "provenance": """select zone, case when zone = 'SE4' then 'failed' else 'done' end as status, case when zone = 'SE4' then 'too few rows' end as reason,
                     count(*) as train_rows from grid_hourly group by zone""",
}


def reports(spark, sf_dir):
    """Reports of the day-ago prediction: weeks as folds, part prices as gains, and one zone said to have failed."""
    r = residuals(spark, sf_dir).withColumn("fold", F.floor(F.dayofmonth("timestamp_utc") / 7).cast("int"))
    folds = r.groupBy("zone", "fold").agg(F.avg("abs_error").alias("mae"), F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"))
    folds = folds.withColumns({"status": F.when(F.col("fold") > 0, "done").otherwise("failed"), "reason": F.when(F.col("fold") == 0, "left out")})
    zone = F.concat(F.lit("SE"), (F.col("p_partkey") % 4 + 1).cast("string"))
    gains = table(spark, sf_dir, "part").groupBy(zone.alias("zone"), F.concat(F.lit("load_mw_lag_"), F.col("p_size").cast("string")).alias("feature"))
    status = F.when(F.col("zone") == "SE4", "failed").otherwise("done").alias("status")
    rows = fx.grid_hourly(spark, sf_dir).groupBy("zone").agg(F.count("*").alias("train_rows"))
    provenance = rows.select("zone", status, F.when(F.col("zone") == "SE4", "too few rows").alias("reason"), "train_rows")
    tested = metrics.regression_metrics(predicted(spark, sf_dir))
    return report.zone_reports(tested, folds, gains.agg(F.sum("p_retailprice").alias("gain")), provenance, top=5)


@query(with_views(_REPORT, "grid_hourly", **_REPORTED), doubles="mae rmse bias mean_mae std_mae", digits=5)
def training_report(spark, sf_dir):
    """K-07: metrics, folds, gains and provenance of each zone in one nested row, written as JSON lines and read back."""
    path = scratch_path(spark, "reports")
    made = materialize(reports(spark, sf_dir), "reports")
    report.write_reports(made, path, "b1")
    report.write_reports(made, path, "b1")
    read = spark.read.schema(made.schema).json(f"{path}/zones")
    rounded = F.transform("cv.fold_mae", lambda x: F.round(x + F.lit(1e-6), 3))
    return read.select(
        "zone", *[F.col(f"test.{c}").alias(c) for c in ("n_test", "mae", "rmse", "bias")], *[F.col(f"cv.{c}").alias(c) for c in ("n_folds", "mean_mae", "std_mae")],
        rounded.alias("fold_mae"), F.col("features.feature").alias("features"), *[F.col(f"provenance.{c}").alias(c) for c in ("status", "reason", "train_rows")],
    )


@query(
    with_views(
        f"""select count(*) as n_zones, count(*) filter (status = 'done') as n_trained, avg(mae) as mean_mae, avg(rmse) as mean_rmse, avg(mean_mae) as cv_mean_mae,
                   arg_min(zone, mae) as best_zone, arg_max(zone, mae) as worst_zone, list(zone || ': ' || reason order by zone) filter (status <> 'done') as failed
            from ({_REPORT})""",
        "grid_hourly",
        **_REPORTED,
    ),
    doubles="mean_mae mean_rmse cv_mean_mae",
    digits=5,
)
def training_summary(spark, sf_dir):
    """K-07 and M-08: the report across zones."""
    out = report.across_zones(reports(spark, sf_dir))
    return out.withColumn("failed", F.transform("failed", lambda x: F.concat(x["zone"], F.lit(": "), x["reason"])))

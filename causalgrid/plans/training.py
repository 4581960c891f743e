"""Boosted trees per zone: fits and walk-forward folds as jobs, stored as tables that are scored in one scan.

A model sees missing values as a number below every possible one, so a split can send them to
either side of anything. A run is a folder: the training rows by zone, the trees of all jobs, one row per job
whether it succeeded or not, and the notes that say what the models expect.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from functools import partial

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from causalgrid.functions.numeric import CLIP_LOWER
from causalgrid.operators import metrics, split
from causalgrid.operators.chunks import Grid
from causalgrid.operators.validate import require_columns
from causalgrid.plans import forest
from causalgrid.plans.gold import feature_columns
from causalgrid.session import scratch_path

MISSING = 2 * CLIP_LOWER
#: The job that fits on all training rows; walk-forward folds count from 1.
FINAL = 0
JOB = (
    "zone string, fold int, status string, reason string, train_rows long, test_rows long, train_from timestamp, train_to timestamp, "
    "fitted_trees int, kept_trees int, watch_error double, mae double, rmse double"
)


@dataclass(frozen=True)
class TrainConfig:
    """The tree settings come as near to the published ones as this learner allows."""

    target: str = "imbalance_mwh"
    test_rows: int = 168
    folds: int = 5
    gap: int = 168
    min_train_rows: int = 50
    trees: int = 2_000
    patience: int = 50
    learning_rate: float = 0.05
    depth: int = 7
    bins: int = 255
    min_leaf_rows: int = 50
    feature_share: str = "0.8"
    row_share: float = 0.85
    watch_share: float = 0.10
    seed: int = 42
    workers: int = 4


@dataclass(frozen=True)
class Fitted:
    """A model, the error of every prefix of it on the watched rows, and how many trees to keep."""

    model: GBTRegressionModel
    errors: list[float]
    kept: int


@dataclass(frozen=True)
class Run:
    """Where a training run is, and what its models expect."""

    path: str
    features: list[str]
    config: TrainConfig
    ts: str
    rows_schema: StructType

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.rows_schema).parquet(f"{self.path}/rows")

    def forests(self, spark: SparkSession, fold: int = FINAL) -> DataFrame:
        """The trees of all zones whose job succeeded."""
        done = self.jobs(spark).where((F.col("fold") == fold) & (F.col("status") == "done")).collect()
        paths = [forest_path(self.path, r.zone, fold) for r in done]
        return spark.read.schema(forest.SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], forest.SCHEMA)

    def jobs(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(JOB).parquet(f"{self.path}/jobs")


def forest_path(path: str, zone: str, fold: int) -> str:
    """Jobs run side by side, so each writes to a folder of its own; a zone's name may hold anything."""
    return f"{path}/forests/{zone.encode().hex()}-{fold}"


def prepared(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Features as doubles without NULL."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in features}
    return df.where(F.col(target).isNotNull()).withColumns(filled)


def fit(rows: DataFrame, features: Sequence[str], cfg: TrainConfig, index: str = split.INDEX, total: str = split.TOTAL) -> Fitted:
    """Fit on prepared rows; the last tenth of them watches and says how many trees are kept.

    Boosting ends once ``patience`` trees in a row bring no gain. The learner has no such rule, but its first trees are the same for any
    number of them, so longer and longer forests are fitted until one holds the stop: less than twice the trees of the last.
    """
    watched = rows.withColumn("_watch", split.early_stop_slice(F.col(index), F.col(total), cfg.watch_share))
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(watched)
    vectors = vectors.select("features", F.col(cfg.target).cast("double").alias("label"), "_watch").persist()
    try:
        learn, watch = vectors.where("not _watch"), vectors.where("_watch")
        size = min(cfg.trees, 2 * cfg.patience)
        while True:
            model = boosting(cfg, size).fit(learn)
            errors = list(model.evaluateEachIteration(watch, "absolute"))
            kept, stopped = forest.best_prefix(errors, cfg.patience)
            if stopped or size >= cfg.trees:
                return Fitted(model, errors, kept)
            size = min(2 * size, cfg.trees)
    finally:
        vectors.unpersist()


def boosting(cfg: TrainConfig, trees: int) -> GBTRegressor:
    return GBTRegressor(
        lossType="absolute",
        maxIter=trees,
        stepSize=cfg.learning_rate,
        maxDepth=cfg.depth,
        maxBins=cfg.bins,
        minInstancesPerNode=cfg.min_leaf_rows,
        featureSubsetStrategy=cfg.feature_share,
        subsamplingRate=cfg.row_share,
        seed=cfg.seed,
    )


def attempted(spark: SparkSession, jobs: Sequence[tuple[str, int]], work: Callable[[str, int], dict], workers: int) -> list[dict]:
    """Run jobs side by side, each in a scheduler pool of its own; one that fails is a row with its reason and stops no other."""

    def attempt(k: int, zone: str, fold: int) -> dict:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"train-{k % max(1, workers)}")
        try:
            return {"zone": zone, "fold": fold, "status": "done", "reason": None, **work(zone, fold)}
        except Exception as e:  # noqa: BLE001
            return {"zone": zone, "fold": fold, "status": "failed", "reason": f"{type(e).__name__}: {e}".splitlines()[0]}
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, workers)) as pool:
        return list(pool.map(lambda job: attempt(job[0], *job[1]), enumerate(jobs)))


def zones_of(gold: DataFrame) -> list[str]:
    return sorted(r.zone for r in gold.select("zone").where("zone is not null").distinct().collect())


def training_rows(gold: DataFrame, features: Sequence[str], cfg: TrainConfig, grid: Grid = Grid()) -> DataFrame:
    """Ready rows with ``split`` and the index of training rows, prepared; a zone with too few rows has no split."""
    ready = gold.where("feature_ready") if "feature_ready" in gold.columns else gold
    # the split counts the rows a model can use, so rows without a target go first
    return split.marked(split.with_row_index(prepared(ready, features, cfg.target), grid), cfg.test_rows)


def train_zones(
    gold: DataFrame,
    cfg: TrainConfig = TrainConfig(),
    features: Sequence[str] | None = None,
    grid: Grid = Grid(),
    zones: Sequence[str] | None = None,
    folds: Sequence[int] = (FINAL,),
    path: str | None = None,
) -> Run:
    """Fit every zone, and every walk-forward fold in ``folds``; the run has ``zones x folds`` job rows.

    Training rows are stored by zone once, so a job reads the folder of its own zone and no other.
    """
    spark = gold.sparkSession
    features = list(features or feature_columns(gold, cfg.target))
    require_columns(gold, ["zone", grid.ts, cfg.target, *features], "feature table")
    path = path or scratch_path(spark, "training")
    rows = training_rows(gold, features, cfg, grid).select(
        grid.ts, F.col(cfg.target).cast("double").alias(cfg.target), *features, split.INDEX, split.TOTAL, "split", "zone"
    )
    by_zone = rows.withColumn("_year", F.year(grid.ts)).repartition("zone", "_year").drop("_year").sortWithinPartitions("zone", grid.ts)
    by_zone.write.mode("overwrite").partitionBy("zone").parquet(f"{path}/rows")
    run = Run(path, features, cfg, grid.ts, rows.schema)
    zones = list(zones or zones_of(gold))
    done = attempted(spark, [(z, k) for z in zones for k in folds], partial(one_job, spark, run), cfg.workers)
    names = StructType.fromDDL(JOB).names
    spark.createDataFrame([tuple(r.get(n) for n in names) for r in done], JOB).coalesce(1).write.mode("overwrite").parquet(f"{path}/jobs")
    notes = {"features": features, "config": asdict(cfg), "ts": grid.ts, "rows": rows.schema.jsonValue()}
    spark.createDataFrame([(json.dumps(notes),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/notes")
    return run


def load(spark: SparkSession, path: str) -> Run:
    notes = json.loads(spark.read.text(f"{path}/notes").first().value)
    return Run(path, notes["features"], TrainConfig(**notes["config"]), notes["ts"], StructType.fromJson(notes["rows"]))


def one_job(spark: SparkSession, run: Run, zone: str, fold: int) -> dict:
    """Fit a zone, or a fold of it, store its trees and measure them on the rows after those it saw."""
    cfg = run.config
    mine = run.rows(spark).where(F.col("zone") == zone)
    if not mine.limit(1).count():
        raise ValueError(f"{zone} has no usable rows")
    mine = mine.where("split is not null")
    if fold == FINAL:
        train = mine.where("split = 'train'").withColumn(split.TOTAL, F.col(split.TOTAL) - cfg.test_rows)
        test = mine.where("split = 'test'")
    else:
        inner = mine.where("split = 'train'").withColumn(split.TOTAL, F.col(split.TOTAL) - cfg.test_rows)
        roles = inner.withColumn("_role", split.fold_role(F.lit(fold), cfg.folds, cfg.gap))
        until = split.fold_bounds(F.lit(fold), cfg.folds, cfg.gap)[0]
        train, test = roles.where("_role = 'train'").withColumn(split.TOTAL, until), roles.where("_role = 'test'")
    facts = train.agg(F.count("*").alias("n"), F.min(run.ts).alias("a"), F.max(run.ts).alias("b")).first()
    if facts.n < cfg.min_train_rows:
        raise ValueError(f"{facts.n} training rows, {cfg.min_train_rows} needed")
    fitted = fit(train, run.features, cfg)
    kept = forest.trees_of(spark, fitted.model).where(F.col("tree") < fitted.kept).withColumn("zone", F.lit(zone))
    own = forest_path(run.path, zone, fold)
    kept.select(*StructType.fromDDL(forest.SCHEMA).names).coalesce(1).write.mode("overwrite").parquet(own)
    scored = forest.predictions(test.select("zone", cfg.target, *run.features), spark.read.schema(forest.SCHEMA).parquet(own), run.features, MISSING)
    e = F.col("y_pred") - F.col(cfg.target)
    found = scored.agg(F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse")).first()
    return {
        "train_rows": facts.n, "test_rows": found.n, "train_from": facts.a, "train_to": facts.b, "fitted_trees": len(fitted.errors),
        "kept_trees": fitted.kept, "watch_error": float(fitted.errors[fitted.kept - 1]), "mae": found.mae, "rmse": found.rmse,
    }


def walk_forward_scores(
    gold: DataFrame, cfg: TrainConfig = TrainConfig(), features: Sequence[str] | None = None, grid: Grid = Grid(), zones: Sequence[str] | None = None
) -> DataFrame:
    """One row per (zone, fold): MAE and RMSE, or why there are none."""
    run = train_zones(gold, cfg, features, grid, zones, folds=range(1, cfg.folds + 1))
    return run.jobs(gold.sparkSession)


def score(run: Run, table: DataFrame) -> DataFrame:
    """``y_pred`` for the rows of a table that has the run's features; rows of zones without a model are not answered."""
    require_columns(table, ["zone", *run.features], "feature table")
    return forest.predictions(table, run.forests(table.sparkSession), run.features, MISSING)


def held_out(spark: SparkSession, run: Run) -> DataFrame:
    """The test rows of every zone with ``y`` and ``y_pred``, in one scan of them."""
    test = run.rows(spark).where("split = 'test'")
    return score(run, test).select("zone", run.ts, F.col(run.config.target).alias("y"), "y_pred")


def evaluate(spark: SparkSession, run: Run) -> DataFrame:
    """Metrics of the held-out rows beside those of persistence."""
    test = held_out(spark, run)
    return metrics.improvement(metrics.regression_metrics(test, bounded=True), metrics.baseline_metrics(test))


def importances(spark: SparkSession, run: Run) -> DataFrame:
    return forest.gains(run.forests(spark), run.features)


def summary(spark: SparkSession, run: Run) -> DataFrame:
    """One row per zone: its fit, or why it failed, beside the mean and deviation over its folds."""
    jobs = run.jobs(spark)
    fits = jobs.where(F.col("fold") == FINAL).drop("fold")
    folds = jobs.where((F.col("fold") != FINAL) & (F.col("status") == "done"))
    failed = jobs.where(F.col("fold") != FINAL).groupBy("zone").agg(F.count_if(F.col("status") != "done").alias("failed_folds"))
    return fits.join(metrics.cv_summary(folds), "zone", "left").join(failed, "zone", "left").withColumn("n_features", F.lit(len(run.features)))

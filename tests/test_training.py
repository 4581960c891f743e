"""Fits, folds, forests and reports on small tables."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from causalgrid.operators import split
from causalgrid.plans import forest, report, training
from causalgrid.plans.training import TrainConfig

T0 = dt.datetime(2024, 1, 1)
SMALL = TrainConfig(target="y", test_rows=20, folds=2, gap=3, min_train_rows=30, trees=24, patience=3, learning_rate=0.4, depth=3, bins=32, min_leaf_rows=2)
NAMES = ["a", "b", "c"]


def table(spark, sizes, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for zone, n in sizes.items():
        for i in range(n):
            a, b = float(rng.normal()), float(rng.uniform(-3, 3))
            rows.append((zone, T0 + dt.timedelta(hours=i), 3 * a + b * b + float(rng.normal(0, 0.3)), a, b if i % 9 else None, float(i % 24)))
    return spark.createDataFrame(rows, "zone string, timestamp_utc timestamp, y double, a double, b double, c double")


def test_best_prefix():
    rng = np.random.default_rng(2)
    for _ in range(200):
        errors = rng.integers(0, 12, rng.integers(1, 30)).tolist()
        patience = int(rng.integers(1, 8))
        kept, stopped = forest.best_prefix(errors, patience)
        # by hand: the first stretch of so many trees without a new least error ends the boosting
        end = next((k for k in range(len(errors)) if k >= patience and min(errors[: k - patience + 1]) <= min(errors[k - patience + 1 : k + 1])), None)
        seen = errors if end is None else errors[: end + 1]
        assert (kept, stopped) == (int(np.argmin(seen)) + 1, end is not None)


def test_trees_answer_as_the_learner_does(spark):
    cfg = SMALL
    rows = training.prepared(table(spark, {"SE1": 200}), NAMES, "y")
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows).withColumn("label", F.col("y")).cache()
    long, short = training.boosting(cfg, 12).fit(vectors), training.boosting(cfg, 5).fit(vectors)
    trees = forest.trees_of(spark, long).withColumn("zone", F.lit("SE1")).cache()
    for model, part in ((long, trees), (short, trees.where("tree < 5"))):  # the first trees are the same for any number of them
        want = {r.timestamp_utc: r.prediction for r in model.transform(vectors).collect()}
        got = {r.timestamp_utc: r.y_pred for r in forest.predictions(rows, part, NAMES, training.MISSING).collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k] == pytest.approx(want[k], abs=1e-9)
    gains = {r.feature: r.gain for r in forest.gains(trees, NAMES).collect()}
    np.testing.assert_allclose([gains[n] for n in NAMES], long.featureImportances.toArray(), atol=1e-9)


def test_fit_keeps_the_best_prefix(spark):
    rows = split.with_row_index(training.prepared(table(spark, {"SE1": 160}), NAMES, "y"))
    fitted = training.fit(rows, NAMES, SMALL)
    whole = training.fit(rows, NAMES, TrainConfig(**{**SMALL.__dict__, "patience": 1_000}))
    kept, _ = forest.best_prefix(whole.errors, SMALL.patience)
    assert fitted.kept == kept and len(whole.errors) == SMALL.trees
    np.testing.assert_allclose(fitted.errors, whole.errors[: len(fitted.errors)])


def test_zones_of_all_blocks_are_answered(spark):
    def tree(zone, k, cut):
        return (zone, k, 1.0 if k == 0 else 0.5, [0, -1, 1, -1, -1], [cut, 0.0, 1.0, 0.0, 0.0], [1, -1, 3, -1, -1], [2, -1, 4, -1, -1], [0.0, 1.0, 0.0, 10.0, 100.0], [1.0] * 5)

    trees = spark.createDataFrame([tree(z, k, float(i + k)) for i, z in enumerate(("SE1", "SE2", "odd zone")) for k in range(3)], forest.SCHEMA)
    rows = [(z, float(a), None if a == 4 else float(b)) for z in ("SE1", "SE2", "odd zone", "none", None) for a in range(6) for b in range(3)]
    df = spark.createDataFrame(rows, "zone string, a double, b double")

    def want(zone, a, b):
        i, b = ("SE1", "SE2", "odd zone").index(zone), training.MISSING if b is None else b
        return sum((1.0 if k == 0 else 0.5) * (1.0 if a <= i + k else 10.0 if b <= 1 else 100.0) for k in range(3))

    expected = sorted(want(*r) for r in rows if r[0] not in ("none", None))
    assert len(forest.blocks_of(trees, 1)) == 3
    for held in (1, 1 << 20):
        got = forest.predictions(df, trees, ["a", "b"], training.MISSING, held=held)
        assert got.columns == ["zone", "a", "b", "y_pred"]
        assert sorted(r.y_pred for r in got.collect()) == pytest.approx(expected)
    assert forest.predictions(df, trees.limit(0), ["a", "b"], training.MISSING).count() == 0


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    gold = table(spark, {"SE1": 150, "SE/2 ": 140, "SE3": 30, "SE4": 60})
    gold = gold.withColumn("y", F.when(F.col("zone") != "SE5", F.col("y")))
    path = str(tmp_path_factory.mktemp("run"))
    return training.train_zones(gold, SMALL, NAMES, zones=["SE1", "SE/2 ", "SE3", "SE4", "SE9"], folds=(training.FINAL, 1, 2), path=path), gold


def test_every_job_is_a_row(spark, run):
    jobs = {(r.zone, r.fold): r for r in run[0].jobs(spark).collect()}
    assert len(jobs) == 5 * 3
    assert {k for k, r in jobs.items() if r.status == "done"} == {(z, k) for z in ("SE1", "SE/2 ") for k in (0, 1, 2)} | {("SE4", 0)} - {(z, k) for (z, k), r in jobs.items() if r.reason}
    assert "no usable rows" in jobs["SE9", 0].reason and "training rows" in jobs["SE3", 0].reason
    fit = jobs["SE1", 0]
    assert (fit.train_rows, fit.test_rows, fit.train_from, fit.train_to) == (130, 20, T0, T0 + dt.timedelta(hours=129))
    assert fit.kept_trees <= fit.fitted_trees and fit.mae < 2.5
    assert run[0].forests(spark).where("zone = 'SE1'").count() == fit.kept_trees


def test_a_fit_reads_its_own_zone(spark, run):
    plan = run[0].rows(spark).where(F.col("zone") == "SE1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(zone" in plan and "(zone#" in plan
    files = run[0].rows(spark).where(F.col("zone") == "SE1").select(F.input_file_name()).distinct().collect()
    assert all("/zone=SE1/" in r[0] for r in files)


def test_a_stored_run_is_the_run(spark, run):
    loaded = training.load(spark, run[0].path)
    assert loaded == run[0]
    want = sorted((r.zone, r.mae, r.n_test) for r in training.evaluate(spark, run[0]).collect())
    assert sorted((r.zone, r.mae, r.n_test) for r in training.evaluate(spark, loaded).collect()) == want
    jobs = {r.zone: r.mae for r in loaded.jobs(spark).where("fold = 0").collect()}
    assert all(jobs[z] == pytest.approx(mae) for z, mae, _ in want)
    live = training.score(loaded, run[1].drop("y"))
    assert live.columns[-1] == "y_pred" and {r.zone for r in live.select("zone").distinct().collect()} == set(z for z, _, _ in want)
    with pytest.raises(ValueError, match="b"):
        training.score(loaded, run[1].drop("b"))


def test_reports_name_failed_zones(spark, run, tmp_path):
    reports = report.run_reports(spark, run[0], top=2)
    by = {r.zone: r for r in reports.collect()}
    assert set(by) == {"SE1", "SE/2 ", "SE3", "SE4", "SE9"}
    assert by["SE9"].test is None and by["SE9"].provenance.status == "failed" and len(by["SE9"].cv.failed_folds) == 2
    assert len(by["SE1"].cv.fold_mae) == 2 and [f.feature for f in by["SE1"].features][0] in NAMES and len(by["SE1"].features) == 2
    total = report.across_zones(reports).first()
    assert total.n_zones == 5 and total.n_trained + len(total.failed) == 5 and total.best_zone in by
    for _ in range(2):
        report.write_reports(reports, str(tmp_path / "reports"), "b1")
    assert spark.read.json(str(tmp_path / "reports" / "zones")).count() == 5
    assert spark.read.json(str(tmp_path / "reports" / "summary")).count() == 1
    summary = {r.zone: r for r in training.summary(spark, run[0]).collect()}
    assert summary["SE1"].n_folds == 2 and summary["SE3"].failed_folds == 2 and summary["SE1"].n_features == 3

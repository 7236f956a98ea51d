"""Boosting within one task grows the library's trees."""

import threading

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from conftest import SF01
from sessionbars.operators import ml, trees
from sessionbars.operators.features import build_features
from sessionbars.plans.adapters import event_bars


def vectors(spark, n, seed):
    """Numbers of few, many and one value, and two yes-or-no features; label with ties."""
    rng = np.random.default_rng(seed)
    rows = [(float(rng.normal()), float(rng.integers(0, 4)), 7.0, float(max(0.0, rng.normal())), float(i % 2), float(rng.random() < 0.1), float(np.round(rng.normal(), 1))) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double, target double").coalesce(1)
    yes = lambda c: F.col(c).alias(c, metadata={"ml_attr": {"type": "binary", "name": c}})
    df = df.select("a", "b", "c", "d", yes("e"), yes("f"), "target")
    return VectorAssembler(inputCols=list("abcdef"), outputCol="features").transform(df).select("features", "target")


@pytest.mark.parametrize("n, depth, rate, share", [(9, 3, 0.8, "0.8"), (60, 8, 0.9, "0.5"), (700, 5, 0.6, "0.9")])
def test_same_errors_as_the_library(spark, n, depth, rate, share):
    a, b = (ml.stored(vectors(spark, m, s)) for m, s in ((n, 1), (40, 2)))
    kinds = trees.arities(a)
    assert kinds == [0, 0, 0, 0, 2, 2]
    est = ml.gbt(maxDepth=depth, maxIter=6, subsamplingRate=rate, featureSubsetStrategy=share)
    params = trees.fits_in_a_task(est, n, kinds)
    folds = spark.sparkContext.broadcast({4: (*(trees.matrix(v, "target", 6) for v in (a, b)), kinds)})
    got = trees.boosting_errors(spark, {"one": (4, params)}, folds)["one"]
    assert np.allclose(got, list(est.fit(a).evaluateEachIteration(b, "absolute")), rtol=1e-12, atol=1e-12)


def test_what_a_task_leaves_to_the_library(spark):
    est = ml.gbt()
    assert trees.fits_in_a_task(est, 50, [0, 2]) and trees.fits_in_a_task(est, 50, None) is None
    assert trees.fits_in_a_task(est, trees.MOST_ROWS + 1, [0, 2]) is None
    for other in ({"minInstancesPerNode": 2}, {"maxBins": 16}, {"subsamplingRate": 1.0}, {"featureSubsetStrategy": "sqrt"}, {"weightCol": "w"}):
        assert trees.fits_in_a_task(ml.gbt(**other), 50, [0, 2]) is None
    df = vectors(spark, 5, 3)
    assert trees.all_finite(df, "target")
    for odd in (None, float("nan"), float("inf")):
        assert not trees.all_finite(df.withColumn("target", F.lit(odd).cast("double")), "target")
    assert trees.arities(spark.createDataFrame([(1,)], "features int")) is None


def test_search_of_small_folds_runs_no_library_fit(spark, monkeypatch):
    """The same table as with the library's fits, on folds of one partition."""
    feats = build_features(event_bars(spark, SF01))
    train = ml.chronological_split(feats).filter(F.col("split") == "train").drop("split").cache()
    grid = {"maxDepth": [3, 6], "stepSize": [0.15], "maxIter": [2, 5], "subsamplingRate": [0.8], "featureSubsetStrategy": ["0.9"]}
    fits, fit = [], ml.GBTRegressor.fit
    monkeypatch.setattr(ml.GBTRegressor, "fit", lambda self, *a: (fits.append(1), fit(self, *a))[1])
    best, table = ml.grid_search(train, grid, k=2, rows_per_partition=ml.ROWS_PER_PARTITION)
    got = table.orderBy("combo").collect()
    assert not fits
    monkeypatch.setattr(trees, "fits_in_a_task", lambda *a: None)
    want_best, want = ml.grid_search(train, grid, k=2, rows_per_partition=ml.ROWS_PER_PARTITION)
    assert len(fits) == 4 and best == want_best
    for a, b in zip(got, want.orderBy("combo").collect(), strict=True):
        assert (a["combo"], a["params"]) == (b["combo"], b["params"]) and abs(a["mean_mae"] - b["mean_mae"]) < 1e-9 * b["mean_mae"]
    train.unpersist()


def test_a_search_of_small_folds_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    feats = build_features(event_bars(spark, SF01))
    train = ml.chronological_split(feats).filter(F.col("split") == "train").drop("split").cache()
    grid = {"maxDepth": [2, 3], "stepSize": [0.1], "maxIter": [1, 2], "subsamplingRate": [0.8], "featureSubsetStrategy": ["0.8"]}
    args = {"k": 2, "rows_per_partition": ml.ROWS_PER_PARTITION, "store": str(tmp_path / "search")}
    asked, some = [], trees.boosting_errors

    def cut(spark, jobs, folds):
        asked.append(list(jobs))
        if len(asked) == 2:
            raise RuntimeError("lost")
        return some(spark, dict(list(jobs.items())), folds)

    monkeypatch.setattr(trees, "boosting_errors", cut)
    monkeypatch.setattr(ml, "PARALLEL_FITS", 1)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda self: 1))
    with pytest.raises(RuntimeError, match="lost"):
        ml.grid_search(train, grid, **args)
    asked.append([])
    best, table = ml.grid_search(train, grid, **args)
    assert [len(x) for x in asked] == [2, 2, 0, 2] and asked[3] == asked[1]
    monkeypatch.setattr(trees, "boosting_errors", some)
    want_best, want = ml.grid_search(train, grid, k=2, rows_per_partition=ml.ROWS_PER_PARTITION)
    assert best == want_best and sorted(map(tuple, table.collect())) == sorted(map(tuple, want.collect()))
    train.unpersist()


def test_members_are_fitted_side_by_side_on_stored_rows(spark, monkeypatch):
    """Few rows are one partition, their lineage is cut, and no member waits for another."""
    feats = build_features(event_bars(spark, SF01)).repartition(5).cache()
    seen, fit, plan = [], ml.fit, lambda rows: rows._jdf.queryExecution().executedPlan().toString()
    together = threading.Barrier(4)

    def met(est, rows, *a):
        seen.append((rows.rdd.getNumPartitions(), plan(rows)))
        together.wait(60)
        return fit(est, rows, *a)

    monkeypatch.setattr(ml, "fit", met)
    grid = {"maxDepth": [2], "stepSize": [0.1], "maxIter": [2], "subsamplingRate": [0.8], "featureSubsetStrategy": ["0.8"]}
    res = ml.train_ensemble(feats, grid, {"rf": {"numTrees": 3}, "gbt2": {"maxIter": 2}})
    assert list(res["members"]) == list(ml.ENSEMBLE_WEIGHTS) and len(seen) == 4
    assert [type(m.stages[-1]).__name__ for m in res["members"].values()] == ["GBTRegressionModel", "RandomForestRegressionModel", "GBTRegressionModel", "LinearRegressionModel"]
    assert all(n == 1 and "ExistingRDD" in p and "InMemory" not in p for n, p in seen)
    feats.unpersist()

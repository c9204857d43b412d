"""Shared fits equal separate fits; exact-size samples."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tessera.operators import metrics, models, split, tune
from tessera.plans import classifiers


@pytest.fixture(scope="module")
def folded(spark):
    train, test, width = classifiers.prepared(spark, "/root/testdata/sf0.01")
    train = train.withColumn("fold", split.hash_fold("vec_id", 2, "test")).cache()
    yield train, test, width
    train.unpersist()


def test_prefix_equals_a_fit_of_fewer_rounds(spark, folded):
    train, test, _ = folded
    whole = models.gbt(max_iter=6, max_depth=3).setStepSize(0.2).fit(train)
    for rounds in (1, 3, 6):
        alone = models.gbt(max_iter=rounds, max_depth=3).setStepSize(0.2).fit(train)
        cut = models.boosted_prefix(whole, rounds)
        assert cut.getNumTrees == rounds and cut.treeWeights == alone.treeWeights
        both = [m.transform(test).orderBy("vec_id").select(metrics.positive_score().alias("p"), "prediction").collect()
                for m in (alone, cut)]
        assert both[0] == both[1]


def test_prefix_search_equals_separate_fits(spark, folded):
    train, _, _ = folded
    est = models.gbt()
    grid = tune.param_grid(est, {"maxDepth": [1, 3], "maxIter": [2, 4], "stepSize": [0.1, 0.3]})
    found = tune.prefix_search(est, grid, train, "label", "fold", 2, rounds="maxIter", prefix=models.boosted_prefix)
    assert sorted(map(sorted, tune.shared_fits(grid, "maxIter"))) == [[0, 2], [1, 3], [4, 6], [5, 7]]
    evaluator = MulticlassClassificationEvaluator()
    for i, pm in enumerate(grid):
        scores = [evaluator.evaluate(est.fit(train.where(F.col("fold") != k), pm).transform(train.where(F.col("fold") == k)))
                  for k in range(2)]
        assert found.avgMetrics[i] == pytest.approx(np.mean(scores), abs=1e-12)
        assert found.stdMetrics[i] == pytest.approx(np.std(scores), abs=1e-12)
    table = tune.grid_table(spark, found, "gbt")
    assert table.count() == 8
    best = int(np.argmax(found.avgMetrics))
    assert found.bestModel.getNumTrees == grid[best][est.maxIter]


def test_stages_are_fitted_inside_each_fold(spark, folded):
    train, _, width = folded
    est = classifiers._estimator("perceptron", width)
    grid = classifiers._grid("perceptron", est, {"maxIter": [3, 5], "layers": [(4,)]}, width)
    found = classifiers._search("perceptron", est, grid, train.drop("fold"), 2, 4)
    assert len(found.bestModel.stages) == 2 and all(0 <= m <= 1 for m in found.avgMetrics)


def test_every_map_of_every_model_is_searched(spark):
    """The full grids, on a small table and two folds."""
    fitted = classifiers.tune_models(spark, SF_SMALL, folds=2)
    tables = {name: tune.grid_table(spark, cv, name).collect() for name, cv, _ in fitted}
    assert {n: len({r["params"] for r in rows}) for n, rows in tables.items()} \
        == {"random_forest": 27, "gbt": 27, "perceptron": 8}
    for name, cv, row in fitted:
        assert row["cv_f1"] == max(cv.avgMetrics) and 0 <= row["accuracy"] <= 1 and row["n_test"] > 0


def test_f1_of_counts(spark):
    rows = [(0.0, 0.0, 5), (0.0, 1.0, 2), (1.0, 1.0, 3), (1.0, 0.0, 4), (2.0, 0.0, 1)]
    frame = spark.createDataFrame([(y, p) for y, p, n in rows for _ in range(n)], "label double, prediction double")
    assert metrics.f1_of_counts(rows) == pytest.approx(metrics.weighted_f1(frame, "label").first()["weighted_f1"])
    assert metrics.f1_of_counts([]) == 0


# ---- exact samples


def order(salt, *keys):
    return int(hashlib.md5((salt + ":".join(str(k) for k in keys if k is not None)).encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("rows_per_bin", [1, 7, 4096])
def test_smallest_hashes_are_exact(spark, rows_per_bin):
    rows = [(i, None if i % 11 == 0 else "abc"[i % 3 if i % 5 else 0]) for i in range(700)]
    frame = spark.createDataFrame(rows, "id long, cls string").repartition(5)
    got = split.smallest_hashes(frame, ["id"], ["cls"], lambda n, _: F.least(n, F.lit(60)), "s", rows_per_bin).collect()
    want = []
    for cls in {c for _, c in rows}:
        want += sorted((r for r in rows if r[1] == cls), key=lambda r: (order("s", r[0]), r[0]))[:60]
    assert Counter(map(tuple, got)) == Counter(want)


def test_sizes_at_the_ends(spark):
    frame = spark.range(100).withColumn("_hash_", F.lit(1))
    for size, n in [(0, 0), (1, 1), (99, 99), (100, 100), (10_000, 100)]:
        assert split.smallest_hashes(frame, ["id"], [], lambda *_: F.lit(size), rows_per_bin=3).count() == n
    assert split.smallest_hashes(frame.where("id < 0"), ["id"], [], lambda rows, _: rows).count() == 0
    repeated = frame.select(F.lit(7).alias("id"))
    assert split.smallest_hashes(repeated, ["id"], [], lambda *_: F.lit(40), rows_per_bin=3).count() == 40


def test_rebalanced_classes_are_equal(spark):
    rows = [(i, float(i % 4 == 0), "x") for i in range(400)]
    frame = spark.createDataFrame(rows, "id long, label double, _g0 string")
    for parts in (1, 6):
        kept = split.rebalance(frame.repartition(parts), "id", "label", "s")
        assert {r[0]: r[1] for r in kept.groupBy("label").count().collect()} == {0.0: 100, 1.0: 100}
    assert split.rebalance(frame.where("id < 0"), "id", "label").count() == 0
    halves = split.exact_stratified_sample(frame, "id", "label", {0.0: 0.5, 1.0: 0.333})
    assert {r[0]: r[1] for r in halves.groupBy("label").count().collect()} == {0.0: 150, 1.0: 33}
    assert split.exact_sample(frame, ["id", "label"], 0.25).count() == 100
    assert kept.columns == frame.columns and {r[2] for r in kept.collect()} == {"x"}  # clashing names are kept


def test_the_sample_moves_little_data(spark):
    """Only the wait list is sorted: the rows certain to stay pass no exchange."""
    frame = spark.range(0, 200_000, 1, 8)
    out = split.smallest_hashes(frame, ["id"], [], lambda n, _: F.floor(n / 2))
    assert out.count() == 100_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan

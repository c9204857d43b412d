"""Fits on counted rows are fits on all rows; named folds equal CrossValidator's."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tessera.operators import features as feat
from tessera.operators import models, tune


@pytest.fixture(scope="module")
def rows(spark):
    base = spark.range(240).select((F.col("id") % 3).cast("double").alias("a"), (F.col("id") % 7 % 4).cast("int").alias("y"),
                                   (F.col("id") % 5 % 2).cast("int").alias("fold"))
    return VectorAssembler(inputCols=["a"], outputCol="features").transform(base).persist()


def test_counted_fit_equals_fit_of_all_rows(spark, rows):
    counts = VectorAssembler(inputCols=["a"], outputCol="features").transform(feat.counted(rows, ["a", "y"]))
    assert counts.count() == 12 and counts.agg(F.sum("n")).first()[0] == 240
    whole = models.poisson_glm("y").setTol(1e-12).fit(rows)
    few = models.poisson_glm("y", weight="n").setTol(1e-12).fit(counts)
    assert few.intercept == pytest.approx(whole.intercept, abs=1e-9)
    assert few.coefficients[0] == pytest.approx(whole.coefficients[0], abs=1e-9)


def test_named_folds_equal_cross_validator(spark, rows):
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withStd=True, withMean=False)
    est = models.poisson_glm("y", "scaled")
    grid = tune.param_grid(est, {"regParam": [0.01, 1.0]})
    ev = RegressionEvaluator(labelCol="y", metricName="rmse")
    new = tune.cross_validate(est, grid, ev, rows, folds=2, fold_col="fold", stages=scaler)
    old = CrossValidator(estimator=Pipeline(stages=[scaler, est]), estimatorParamMaps=grid, evaluator=ev, numFolds=2,
                         foldCol="fold").fit(rows)
    assert new.avgMetrics == pytest.approx(old.avgMetrics, abs=1e-12)
    assert new.stdMetrics == pytest.approx(old.stdMetrics, abs=1e-12)
    assert new.bestModel.stages[-1].getRegParam() == old.bestModel.stages[-1].getRegParam()


def test_saturated_searches_read_counts(spark):
    from conftest import SF_SMALL

    from tessera.plans import claims, closed_forms
    counts = closed_forms._train_counts(spark, SF_SMALL)
    n = claims.train_test(spark, SF_SMALL)[0].count()
    assert counts.agg(F.sum("n")).first()[0] == n and counts.count() < n and counts.rdd.getNumPartitions() <= 2

import random

import pytest
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)

from tessera.operators import metrics, tune


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(800):
        y = float(rnd.random() < 0.4)
        s = round(min(1.0, max(0.0, rnd.gauss(0.35 + 0.3 * y, 0.2))), 2)  # rounded: many ties
        rows.append((y, s, float(s > 0.5)))
    return spark.createDataFrame(rows, "label double, score double, prediction double")


def test_auc_matches_evaluator_without_bins(scored):
    ours = metrics.area_under_roc(scored, "label", "score").first()["auc"]
    ref = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0).evaluate(scored)
    assert abs(ours - ref) < 1e-12


def test_hard_auc_is_mean_of_tpr_tnr(scored):
    ours = metrics.hard_label_auc(scored, "label").first()["auc_hard"]
    rows = scored.collect()
    tp = sum(1 for r in rows if r.label == 1 and r.prediction == 1)
    tn = sum(1 for r in rows if r.label == 0 and r.prediction == 0)
    p = sum(1 for r in rows if r.label == 1)
    assert abs(ours - (tp / p + tn / (len(rows) - p)) / 2) < 1e-12


def test_grouped_auc_equals_ungrouped(spark, scored):
    from pyspark.sql import functions as F
    two = scored.withColumn("g", F.lit("a")).unionByName(scored.withColumn("g", F.lit("b")))
    got = {r["g"]: r["auc"] for r in metrics.area_under_roc(two, "label", "score", ["g"]).collect()}
    one = metrics.area_under_roc(scored, "label", "score").first()["auc"]
    assert abs(got["a"] - one) < 1e-12 and abs(got["b"] - one) < 1e-12


def test_weighted_f1_and_accuracy_match_evaluator(scored):
    f1 = metrics.weighted_f1(scored, "label").first()["weighted_f1"]
    acc = metrics.accuracy(scored, "label").first()["accuracy"]
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert abs(f1 - ev.evaluate(scored)) < 1e-12
    assert abs(acc - ev.setMetricName("accuracy").evaluate(scored)) < 1e-12


def test_regression_metrics_match_evaluator(scored):
    m = metrics.regression_metrics(scored, "label", "score").first()
    for name in ("rmse", "mse", "mae"):
        ref = RegressionEvaluator(labelCol="label", predictionCol="score", metricName=name).evaluate(scored)
        assert abs(m[name] - ref) < 1e-12
    assert abs(m["rmse"] ** 2 - m["mse"]) < 1e-12 and m["mae"] <= m["rmse"] + 1e-12


def test_best_params_honours_direction(spark):
    rows = [("m", 0, "a=1", "rmse", 0.5, None, False), ("m", 1, "a=2", "rmse", 0.3, None, False),
            ("n", 0, "b=1", "f1", 0.5, None, True), ("n", 1, "b=2", "f1", 0.7, None, True)]
    schema = ("model string, map_index int, params string, metric string, avg_metric double, "
              "std_metric double, larger_is_better boolean")
    best = {r["model"]: r["params"] for r in tune.best_params(spark.createDataFrame(rows, schema)).collect()}
    assert best == {"m": "a=2", "n": "b=2"}


def test_poisson_offset_recovers_rate(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F
    from tessera.operators import models
    # counts = exposure x rate, rate 0.5 for x=0 and 2.0 for x=1
    rows = [(float(x), float(e), float(e * (2.0 if x else 0.5))) for x in (0, 1) for e in (2, 4, 6, 8)]
    df = spark.createDataFrame(rows, "x double, exposure double, y double") \
        .withColumn("log_exposure", F.log("exposure"))
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    m = models.poisson_glm("y", offset="log_exposure").fit(df)
    assert abs(m.intercept - __import__("math").log(0.5)) < 1e-4
    assert abs(m.coefficients[0] - __import__("math").log(4.0)) < 1e-4

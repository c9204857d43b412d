"""Estimators with the settings the analyses use, and model read-outs as tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel, classification
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession

from .features import feature_names


# Spark's ensembles, but for when their trees are wrapped for Python: there,
# every new or copied model wraps them all, as listing its params reads each
# attribute that is no plain property, and fits side by side wait for that.
class RandomForestClassificationModel(classification.RandomForestClassificationModel):
    @property
    def trees(self):
        return super().trees


class GBTClassificationModel(classification.GBTClassificationModel):
    @property
    def trees(self):
        return super().trees


class RandomForestClassifier(classification.RandomForestClassifier):
    def _create_model(self, java_model):
        return RandomForestClassificationModel(java_model)


class GBTClassifier(classification.GBTClassifier):
    def _create_model(self, java_model):
        return GBTClassificationModel(java_model)


def poisson_glm(label: str, features: str = "features", offset: str | None = None,
                reg_param: float = 0.0, weight: str | None = None) -> GeneralizedLinearRegression:
    """Poisson GLM, log link. ``offset`` (e.g. log exposure) makes it a rate model."""
    glm = GeneralizedLinearRegression(family="poisson", link="log", labelCol=label,
                                      featuresCol=features, regParam=reg_param)
    if offset:
        glm.setOffsetCol(offset)
    if weight:
        glm.setWeightCol(weight)
    return glm


def logistic(label: str, features: str = "features", l1: bool = False,
             reg_param: float = 0.0, weight: str | None = None) -> LogisticRegression:
    """Logistic regression; ``l1`` picks the lasso penalty, else ridge."""
    lr = LogisticRegression(labelCol=label, featuresCol=features,
                            elasticNetParam=1.0 if l1 else 0.0, regParam=reg_param)
    if weight:
        lr.setWeightCol(weight)
    return lr


def random_forest(label: str = "label", features: str = "features", max_depth: int = 10,
                  impurity: str = "entropy", seed: int | None = None) -> RandomForestClassifier:
    rf = RandomForestClassifier(labelCol=label, featuresCol=features, maxDepth=max_depth,
                                impurity=impurity)
    if seed is not None:
        rf.setSeed(seed)
    return rf


def gbt(label: str = "label", features: str = "features", max_iter: int = 5,
        max_depth: int = 2, seed: int = 12) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol=features, maxIter=max_iter,
                         maxDepth=max_depth, seed=seed, lossType="logistic")


def boosted_prefix(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` rounds: each round's tree and weight
    depend on the rounds before it only."""
    whole, jvm = model._java_obj, SparkSession.active()._jvm
    trees, weights = whole.trees()[:rounds], whole.treeWeights()[:rounds]  # arrays of the JVM
    cut = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        whole.uid(), trees, weights, model.numFeatures, model.numClasses))
    return model._copyValues(cut, {model.maxIter: rounds})


def perceptron(n_features: int, hidden: tuple[int, ...] = (5, 4), n_classes: int = 2,
               label: str = "label", features: str = "features", max_iter: int = 100,
               block_size: int = 128, seed: int = 17) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features,
                                          layers=[n_features, *hidden, n_classes],
                                          maxIter=max_iter, blockSize=block_size, seed=seed)


def als(user: str = "userId", item: str = "movieId", rating: str = "rating",
        seed: int = 17, rank: int = 10, max_iter: int = 10, reg_param: float = 0.1,
        blocks: int | None = None) -> ALS:
    """Matrix factorisation; cold-start rows are dropped when scoring. Each
    iteration's checkpoint (one row per item, to the session's checkpoint folder)
    cuts the lineage and frees the shuffle files of the iterations before it,
    which hold a row per key and block.
    ``blocks`` sets the user and item block counts (parallelism of each
    half-step). The seeded start depends on it: take it from the table's size."""
    est = ALS(userCol=user, itemCol=item, ratingCol=rating, seed=seed, rank=rank,
              maxIter=max_iter, regParam=reg_param, coldStartStrategy="drop",
              checkpointInterval=1)
    if blocks:
        est = est.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    return est


def kmeans(k: int = 25, seed: int = 17, features: str = "features",
           prediction: str = "cluster") -> KMeans:
    if k < 2:
        raise ValueError("k-means needs k > 1")
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol=prediction)


def coefficients_table(spark: SparkSession, model: PipelineModel, scored: DataFrame,
                       features: str = "features", name: str = "model") -> DataFrame:
    """Intercept and one row per feature slot, named from the vector metadata."""
    last = model.stages[-1]
    names = feature_names(scored, features)
    coefs = last.coefficients.toArray().tolist()
    rows = [(name, "(intercept)", -1, float(last.intercept))]
    rows += [(name, names[i] if i < len(names) else f"f{i}", i, float(c)) for i, c in enumerate(coefs)]
    return spark.createDataFrame(rows, "model string, feature string, position int, coefficient double")

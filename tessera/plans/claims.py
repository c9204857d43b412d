"""Claim counts and claim flags: split, features, Poisson and logistic models,
cross-validated choice of penalty, metrics."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import digest
from ..operators import features as feat
from ..operators import metrics, models, split, tune
from ..session import materialized, scratch_path, shared, stored, together
from ..sources.files import persisted, read_csv, table, write_csv
from ..sources.standins import claims_table

FEATURES = ["Exposure", "o_orderpriority", "o_orderstatus", "c_mktsegment", "o_totalprice", "c_acctbal"]
CATEGORICAL = ["o_orderpriority", "o_orderstatus", "c_mktsegment"]
# Same share of each class in train; the per-class dict is the API.
TRAIN_FRACTIONS = {0: 0.7, 1: 0.7}
SALT = "claims"
# The penalty grid searched for every model.
REG_GRID = [0.001, 0.01, 0.1, 1.0, 10.0]


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claims table with the binary label ``hasClaim``."""
    def build():
        base = claims_table(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
                            table(spark, sf_dir, "customer"))
        return base.withColumn("hasClaim", F.when(F.col("ClaimNb") > 0, 1).otherwise(0))
    # Materialised once: splits, set differences and model folds all read it.
    return materialized(spark, "claims", sf_dir, build)


def train_test(spark, sf_dir):
    return split.stratified_hash_split(claims(spark, sf_dir), "IDpol", "hasClaim", TRAIN_FRACTIONS, SALT)


def claim_flag(spark, sf_dir):
    return claims(spark, sf_dir)


def stratified_split(spark, sf_dir):
    labelled = split.split_label(claims(spark, sf_dir), "IDpol", "hasClaim", TRAIN_FRACTIONS, SALT)
    return labelled.select("IDpol", "hasClaim", "part")


def bernoulli_sample(spark, sf_dir, fraction: float = 0.1, seed: int = 17):
    """A seeded Bernoulli sample of the train part (sampling is the feature
    here). Rows move with partitioning; each row is kept independently."""
    train, _ = train_test(spark, sf_dir)
    return split.seeded_sample(train, fraction, seed).select("IDpol", "ClaimNb", "hasClaim")


def hash_sample(spark, sf_dir, fraction: float = 0.1):
    """The repeatable Bernoulli sample: rows of the train part whose key hashes
    below ``fraction``."""
    train, _ = train_test(spark, sf_dir)
    return split.hash_split(train, "IDpol", fraction, SALT + "-sample")[0].select("IDpol", "ClaimNb", "hasClaim")


def random_hash_split(spark, sf_dir, fraction: float = 0.7):
    """The repeatable random split of all rows, by key hash."""
    part, rest = split.hash_split(claims(spark, sf_dir), "IDpol", fraction, SALT + "-random")
    return part.select("IDpol", F.lit("part").alias("side")).unionByName(rest.select("IDpol", F.lit("rest").alias("side")))


def set_difference(spark, sf_dir):
    """All rows minus the train rows (distinct): the test part, as the original."""
    data = claims(spark, sf_dir)
    train, _ = split.stratified_hash_split(data, "IDpol", "hasClaim", TRAIN_FRACTIONS, SALT)
    return split.set_difference(data, train)


def set_difference_all(spark, sf_dir):
    """Multiset difference on a projection with repeats: counts are kept."""
    cols = ["hasClaim", "o_orderpriority", "c_mktsegment"]
    data = claims(spark, sf_dir)
    train, _ = split.stratified_hash_split(data, "IDpol", "hasClaim", TRAIN_FRACTIONS, SALT)
    return split.set_difference(data.select(cols), train.select(cols), keep_duplicates=True)


def digest_difference(spark, sf_dir):
    """``set_difference`` by digests: rows without an equal stay where they are."""
    train, _ = train_test(spark, sf_dir)
    return digest.digest_difference(claims(spark, sf_dir), train)


def digest_difference_all(spark, sf_dir):
    """``set_difference_all`` by digests."""
    cols = ["hasClaim", "o_orderpriority", "c_mktsegment"]
    train, _ = train_test(spark, sf_dir)
    return digest.digest_difference(claims(spark, sf_dir).select(cols), train.select(cols), keep_duplicates=True)


def _layout(data: DataFrame):
    """Index, one-hot (the least frequent level dropped) and assemble, learnt
    from all rows without their labels: the design matrix of every claim model."""
    return feat.fit_features(data, FEATURES, scaled_col=None)


def _scaler() -> StandardScaler:
    return StandardScaler(inputCol="features", outputCol="scaledFeatures", withStd=True, withMean=False)


def _features(spark, sf_dir):
    data = claims(spark, sf_dir)
    return _layout(data).transform(data)


def category_index(spark, sf_dir):
    data = claims(spark, sf_dir)
    fitted = feat.indexer(CATEGORICAL).fit(data)
    return fitted.transform(data).select("IDpol", *[f"{c}_index" for c in CATEGORICAL])


def one_hot(spark, sf_dir):
    """Per row and categorical column: one-hot width and the hot slot (-1 for
    the dropped last category)."""
    out = _features(spark, sf_dir)

    def slot(c):
        arr = vector_to_array(F.col(f"{c}_index_ohe"))
        return F.struct(F.lit(c).alias("feature"), F.size(arr).alias("width"),
                        (F.array_position(arr, 1.0) - 1).cast("int").alias("hot"))

    return out.select("IDpol", F.explode(F.array(*[slot(c) for c in CATEGORICAL])).alias("s")).select("IDpol", "s.*")


def assembled_features(spark, sf_dir):
    return feat.vector_long(_features(spark, sf_dir), "IDpol", "features")


def sparse_features(spark, sf_dir):
    """The design matrix without its zeros."""
    return feat.vector_entries(_features(spark, sf_dir), "IDpol", "features")


def scaled_features(spark, sf_dir):
    data = _features(spark, sf_dir)
    out = _scaler().fit(data).transform(data)
    return feat.vector_long(out, "IDpol", "scaledFeatures").withColumn("value", F.round("value", 6))


def _one_feature_stages() -> list:
    cats = ["o_orderpriority"]
    return [feat.indexer(cats), feat.encoder(cats),
            VectorAssembler(inputCols=["o_orderpriority_index_ohe"], outputCol="features")]


def _one_feature_pipeline(estimator):
    """A single categorical feature: the fitted model is saturated, so its
    fitted value per category is that category's mean."""
    return Pipeline(stages=[*_one_feature_stages(), estimator])


def _saturated_poisson():
    return models.poisson_glm("ClaimNb", weight="n").setTol(1e-12).setMaxIter(100)


def _poisson_scored(spark, sf_dir):
    train, test = train_test(spark, sf_dir)

    def fit():
        # The GLM solver reads its input anew in every step: once counted, that
        # is a row per category and number of claims.
        layout = Pipeline(stages=_one_feature_stages()).fit(train)
        counts = stored(feat.counted(train, ["o_orderpriority", "ClaimNb"]), "claim-counts")
        return PipelineModel([*layout.stages, _saturated_poisson().fit(layout.transform(counts))])

    model = shared(spark, "saturated-poisson", sf_dir, fit)
    return model, model.transform(test)


def _saturated_logistic():
    """Unpenalised, solved to a tight tolerance so the fitted probabilities
    reach the group rates (the default 1e-6 stops about 1e-6 short)."""
    return models.logistic("hasClaim").setTol(1e-10).setMaxIter(500)


def _logistic_model(spark, sf_dir):
    train, _ = train_test(spark, sf_dir)
    return shared(spark, "saturated-logistic", sf_dir,
                  lambda: _one_feature_pipeline(_saturated_logistic()).fit(train))


def _logistic_scored(spark, sf_dir):
    """``hasClaim, score, prediction`` of the test part, scored once for all
    metrics. A row is predicted 1 when its score exceeds the train part's claim
    rate, so both classes are predicted."""
    def build():
        train, test = train_test(spark, sf_dir)
        rate = train.agg(F.avg("hasClaim")).first()[0]
        scored = _logistic_model(spark, sf_dir).transform(test)
        return scored.select("hasClaim", metrics.positive_score().alias("score")) \
            .withColumn("prediction", (F.col("score") > F.lit(rate)).cast("double"))
    return materialized(spark, "claims-scored", sf_dir, build)


def poisson_rates(spark, sf_dir):
    model, _ = _poisson_scored(spark, sf_dir)
    cats = claims(spark, sf_dir).select("o_orderpriority").distinct()
    return model.transform(cats).select("o_orderpriority", F.round("prediction", 6).alias("rate"))


def poisson_coefficients(spark, sf_dir):
    """Intercept and one coefficient per kept category of the saturated
    Poisson model: log of the dropped category's mean, and log rate ratios."""
    model, scored = _poisson_scored(spark, sf_dir)
    coefs = models.coefficients_table(spark, model, scored, "features", "poisson")
    return coefs.select("feature", "position", F.round("coefficient", 6).alias("coefficient"))


def logistic_rates(spark, sf_dir):
    model = _logistic_model(spark, sf_dir)
    cats = claims(spark, sf_dir).select("o_orderpriority").distinct()
    return model.transform(cats).select("o_orderpriority",
                                        F.round(metrics.positive_score(), 6).alias("rate"))


def regression_metrics(spark, sf_dir):
    _, scored = _poisson_scored(spark, sf_dir)
    m = metrics.regression_metrics(scored, "ClaimNb")
    return m.select(*[F.round(c, 6).alias(c) for c in ("rmse", "mse", "mae")], "n")


def accuracy(spark, sf_dir):
    scored = _logistic_scored(spark, sf_dir)
    return metrics.accuracy(scored, "hasClaim").select(F.round("accuracy", 6).alias("accuracy"), "n")


def weighted_f1(spark, sf_dir):
    scored = _logistic_scored(spark, sf_dir)
    return metrics.weighted_f1(scored, "hasClaim").select(F.round("weighted_f1", 6).alias("weighted_f1"), "n")


def auc_scores(spark, sf_dir):
    scored = _logistic_scored(spark, sf_dir)
    return metrics.area_under_roc(scored, "hasClaim", "score") \
        .select(F.round("auc", 6).alias("auc"), "n")


def auc_hard(spark, sf_dir):
    scored = _logistic_scored(spark, sf_dir)
    return metrics.hard_label_auc(scored, "hasClaim").select(F.round("auc_hard", 6).alias("auc_hard"), "n")


def _model_specs():
    """(name, estimator, evaluator) for the three claim models; every model
    reads the scaled features."""
    return [
        ("poisson", models.poisson_glm("ClaimNb", "scaledFeatures"),
         RegressionEvaluator(labelCol="ClaimNb", metricName="rmse")),
        ("logistic_l1", models.logistic("hasClaim", "scaledFeatures", l1=True),
         BinaryClassificationEvaluator(labelCol="hasClaim", metricName="areaUnderROC")),
        ("logistic_l2", models.logistic("hasClaim", "scaledFeatures", l1=False),
         BinaryClassificationEvaluator(labelCol="hasClaim", metricName="areaUnderROC")),
    ]


FOLDS = 3


def fit_claim_models(spark, sf_dir, folds: int = FOLDS, parallelism: int = 4):
    """Cross-validate each model over its own penalty grid on the train part,
    refit the best on all of train and score the test part.

    The design matrix is the one of ``assembled_features``; the scaler and the
    model are refit inside every fold. Folds are hashes of the key, the same
    for all three models. Fits are seeded and shared by the queries that read
    them (metrics, coefficients, grid).
    """
    return shared(spark, f"claim-models {folds}", sf_dir, lambda: _fit_claim_models(spark, sf_dir, folds, parallelism))


def _fit_claim_models(spark, sf_dir, folds, parallelism):
    train, test = train_test(spark, sf_dir)
    layout = _layout(claims(spark, sf_dir))
    cols = ["IDpol", "ClaimNb", "hasClaim", "features"]
    tr = layout.transform(train).select(*cols, split.hash_fold("IDpol", folds, SALT + "-fold").alias("fold"))
    te = layout.transform(test).select(cols)

    def one(spec):
        name, est, ev = spec
        grid = tune.param_grid(est, {"regParam": REG_GRID})
        cv = tune.cross_validate(est, grid, ev, tr, folds=folds, parallelism=parallelism, fold_col="fold",
                                 stages=_scaler())
        scored = cv.bestModel.transform(te)
        label = "ClaimNb" if name == "poisson" else "hasClaim"
        row = {"model": name, "cv_metric": ev.getMetricName(),
               "cv_best": float(max(cv.avgMetrics) if ev.isLargerBetter() else min(cv.avgMetrics)),
               "rmse": None, "auc": None, "accuracy": None}
        if name == "poisson":
            row["rmse"] = float(metrics.regression_metrics(scored, label).first()["rmse"])
        else:
            row["auc"] = float(metrics.area_under_roc(scored, label, metrics.positive_score()).first()["auc"])
            row["accuracy"] = float(metrics.accuracy(scored, label).first()["accuracy"])
        row["base_rate"] = float(metrics.base_rate(scored, "hasClaim").first()["base_rate"])
        best = cv.bestModel.stages[-1]
        row["reg_param"] = float(best.getOrDefault("regParam"))
        row["n_coefficients"] = int(best.coefficients.size)
        row["n_nonzero"] = int(sum(1 for c in best.coefficients.toArray() if c != 0.0))
        done = best.summary.numIterations if name == "poisson" else best.summary.totalIterations
        row["iterations"], row["converged"] = int(done), bool(done < est.getMaxIter())
        return (name, cv, scored), row

    # The three searches are independent; running them together keeps the
    # cluster busy between the many short iterations of each fit.
    with persisted(tr), persisted(te), ThreadPoolExecutor(max_workers=3) as pool:
        done = together(spark, pool, one, _model_specs())
    return [d[0] for d in done], [d[1] for d in done]


def claim_models(spark, sf_dir):
    """One row per model: chosen penalty, CV metric, test RMSE / AUC / accuracy
    beside the base rate, coefficient counts, and whether the solver stopped
    before its iteration limit."""
    _, results = fit_claim_models(spark, sf_dir)
    schema = ("model string, reg_param double, cv_metric string, cv_best double, rmse double, "
              "auc double, accuracy double, base_rate double, n_coefficients int, n_nonzero int, "
              "iterations int, converged boolean")
    cols = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in results], schema)


def claim_coefficients(spark, sf_dir):
    """Coefficients of the three chosen models, one row per feature slot."""
    fitted, _ = fit_claim_models(spark, sf_dir)
    tables = [models.coefficients_table(spark, cv.bestModel, scored, "features", name)
              for name, cv, scored in fitted]
    return reduce(DataFrame.unionByName, tables)


def csv_round_trip(spark, sf_dir):
    """The claims table written as headered CSV and read back with its schema."""
    data = claims(spark, sf_dir)
    path = scratch_path(spark, "claims-csv")
    write_csv(data, path)
    return read_csv(spark, path, schema=data.schema)


def claim_grid(spark, sf_dir):
    """Every (model, penalty) with its mean and spread over the folds."""
    fitted, _ = fit_claim_models(spark, sf_dir)
    return reduce(DataFrame.unionByName, [tune.grid_table(spark, cv, name) for name, cv, _ in fitted])

"""Tree and neural classifiers on a wide numeric table: class balance, split,
grid search with cross-validation, scores on held-out rows."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics, models, split, tune
from ..session import scratch_path, shared, small_table, together
from ..sources.files import (cast_strings, persisted, read_headerless_csv, read_parquet, read_part,
                             rename_positional, table, write_csv, write_parquet, write_parts)
from ..sources.standins import collision_features

SALT = "collision"
TRAIN_FRACTION = 0.7
SEED = 12
CLASS_FRACTIONS = {0.0: 0.5, 1.0: 0.25}

# The full grids of the original analysis (27, 27 and 8 maps).
# ``layers`` entries are hidden sizes; input and output widths are added.
REFERENCE_GRIDS = {
    "random_forest": {"maxDepth": [1, 5, 10], "maxBins": [10, 20, 50], "numTrees": [1, 5, 10]},
    "gbt": {"maxDepth": [1, 5, 10], "maxIter": [10, 20, 30], "stepSize": [0.1, 0.2, 0.05]},
    "perceptron": {"maxIter": [100, 150], "blockSize": [128, 256], "layers": [(5, 4), (6, 5)]},
}
FOLDS = 5
# Searches are served in this order: boosting refits its best map round by
# round, alone, so it goes first and the others' fits run beside that.
SERVED = ["gbt", "random_forest", "perceptron"]
# Bytes of feature vectors in one partition of a search's rows. Every partition
# sends each tree level's counts for all nodes, features and bins, and each
# gradient, whatever rows it holds: few full partitions, and the cores are kept
# busy by fits side by side.
PARTITION_BYTES = 64 << 20


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_features(table(spark, sf_dir, "embeddings"))


def feature_cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("vec_id", "label")]


def class_balance(spark, sf_dir):
    counts = split.class_counts(features(spark, sf_dir), "label")
    return counts.select("label", "n", *[F.round(c, 6).alias(c) for c in ("fraction", "weight", "keep_fraction")])


def class_weights(spark, sf_dir):
    w = split.with_class_weight(features(spark, sf_dir), "label")
    return w.select("vec_id", "label", F.round("weight", 6).alias("weight"))


def rebalanced(spark, sf_dir):
    """Every class shrunk to exactly the minority's size by key hash (repeatable)."""
    return split.rebalance(features(spark, sf_dir), "vec_id", "label", SALT).select("vec_id", "label")


def exact_stratified_sample(spark, sf_dir):
    """Exactly the floor of a given fraction of each class, by key hash."""
    data = features(spark, sf_dir).select("vec_id", "label")
    return split.exact_stratified_sample(data, "vec_id", "label", CLASS_FRACTIONS, SALT + "-strata")


def stratified_sample(spark, sf_dir):
    """``sampleBy`` with a given fraction per class. Row sets move with
    partitioning; no class exceeds its rows."""
    data = features(spark, sf_dir).select("vec_id", "label")
    return split.stratified_sample(data, "label", CLASS_FRACTIONS, SEED)


def seeded_sample(spark, sf_dir):
    """The seeded forms: ``sampleBy`` rebalancing, then ``randomSplit``. Row
    sets move with partitioning; parts are disjoint and cover the sample."""
    data = split.rebalance_seeded(features(spark, sf_dir).select("vec_id", "label"), "label", SEED)
    train, test = split.random_split(data, [TRAIN_FRACTION, 1 - TRAIN_FRACTION], SEED)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def headerless_csv(spark, sf_dir):
    """Features written as headerless CSV, read back untyped (``_c0..``),
    renamed by position and cast from text to double in one projection."""
    data = features(spark, sf_dir)
    path = scratch_path(spark, "collision-csv")
    write_csv(data, path, header=False)
    raw = spark.read.csv(path)
    return cast_strings(rename_positional(raw, data.columns), "double")


def headerless_csv_typed(spark, sf_dir):
    """The same file with names and types given at the scan."""
    data = features(spark, sf_dir)
    path = scratch_path(spark, "collision-csv")
    write_csv(data, path, header=False)
    return read_headerless_csv(spark, path, data.columns)


def parquet_round_trip(spark, sf_dir):
    """Features written to parquet and scanned back."""
    data = features(spark, sf_dir)
    path = scratch_path(spark, "collision-parquet")
    write_parquet(data, path)
    return read_parquet(spark, path)


def prepared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, int]:
    """Balanced rows, split by key hash, features assembled once (the assembler
    is stateless, so it need not run inside every fold). Both parts are
    written together as parquet under the shared folder and read back per
    part, so the searches read compact files, not the plan behind them. The
    rows' partitions follow their size and not the cluster."""
    def build() -> tuple[str, int, dict[str, int]]:
        data = split.rebalance(features(spark, sf_dir), "vec_id", "label", SALT)
        cols = feature_cols(data)
        assembled = VectorAssembler(inputCols=cols, outputCol="features").transform(data) \
            .select("vec_id", "label", "features")
        labelled = assembled.withColumn(
            "part", F.when(split.hash_uniform("vec_id", SALT + "-split") < TRAIN_FRACTION, F.lit("train"))
            .otherwise(F.lit("test")))
        path = scratch_path(spark, "collision-parts")
        write_parts(labelled, "part", path)
        sizes = {part: read_part(spark, path, "part", part).count() for part in ("train", "test")}
        return path, len(cols), sizes

    path, width, sizes = shared(spark, "collision-parts", sf_dir, build)
    train, test = [read_part(spark, path, "part", part).coalesce(partitions_for(sizes[part], width))
                   for part in ("train", "test")]
    return train, test, width


def partitions_for(rows: int, width: int) -> int:
    """Partitions of so many vectors of ``width`` doubles."""
    return max(1, -(-rows * width * 8 // PARTITION_BYTES))


def _estimator(name: str, n_features: int):
    if name == "random_forest":
        return models.random_forest(seed=SEED)
    if name == "gbt":
        return models.gbt(seed=SEED)
    return models.perceptron(n_features, features="scaled")


def _search(name: str, est, grid: list, train: DataFrame, folds: int, parallelism: int, pool=None):
    """All maps of one model. Boosted models of fewer rounds are prefixes of
    the longest; the perceptron's solver needs inputs of one scale, so a scaler
    is fitted with it, once per fold."""
    rounds = {"rounds": "maxIter", "prefix": models.boosted_prefix} if name == "gbt" else {}
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True) \
        if name == "perceptron" else None
    folded = train.withColumn("fold", split.hash_fold("vec_id", folds, SALT + "-fold"))
    return tune.prefix_search(est, grid, folded, "label", "fold", folds, stages=scaler,
                              parallelism=parallelism, pool=pool, **rounds)


def _grid(name: str, est, axes: dict, n_features: int) -> list:
    axes = dict(axes)
    if "layers" in axes:
        axes["layers"] = [[n_features, *h, 2] for h in axes["layers"]]
    return tune.param_grid(est, axes)


def tune_models(spark, sf_dir, names=("random_forest", "gbt", "perceptron"), grids=None,
                folds: int = FOLDS, parallelism: int = 12):
    """Cross-validate each model on the train part by weighted F1 (the
    multiclass evaluator's default) with key-hash folds, refit the best, score
    the test part. Seeded, so queries reading the same search (comparison, grid,
    best parameters) share its fits. ``parallelism`` is the number of fits under
    way at once over all searches."""
    grids = grids or REFERENCE_GRIDS
    prepared(spark, sf_dir)  # write the parts once before the searches start

    # Independent searches of many short jobs each: run them together, their
    # fits on the same threads.
    with ThreadPoolExecutor(max_workers=parallelism) as fits, ThreadPoolExecutor(max_workers=len(names)) as searches:
        def one(name):
            return shared(spark, f"search {name} {grids[name]!r} {folds}", sf_dir,
                          lambda: _tune_one(spark, sf_dir, name, grids[name], folds, parallelism, fits))

        order = sorted(names, key=SERVED.index)
        found = dict(zip(order, together(spark, searches, one, order), strict=True))
    return [found[name] for name in names]


def _tune_one(spark, sf_dir, name, axes, folds, parallelism, fits):
    train, test, width = prepared(spark, sf_dir)
    with persisted(train), persisted(test):
        est = _estimator(name, width)
        cv = _search(name, est, _grid(name, est, axes, width), train, folds, parallelism, fits)
        scored = cv.bestModel.transform(test).select(
            "label", "prediction", metrics.positive_score().alias("score"))
        row = {"model": name, "cv_f1": float(max(cv.avgMetrics))}
        acc = metrics.accuracy(scored, "label").first()
        row["accuracy"], row["n_test"] = float(acc["accuracy"]), int(acc["n"])
        row["weighted_f1"] = float(metrics.weighted_f1(scored, "label").first()["weighted_f1"])
        row["auc_hard"] = float(metrics.hard_label_auc(scored, "label").first()["auc_hard"])
        row["auc"] = float(metrics.area_under_roc(scored, "label", "score").first()["auc"])
        row["base_rate"] = float(metrics.base_rate(scored, "label").first()["base_rate"])
    return name, cv, row


_SCHEMA = ("model string, params string, cv_f1 double, accuracy double, weighted_f1 double, "
           "auc_hard double, auc double, base_rate double, n_test bigint")


def _comparison(spark, fitted) -> DataFrame:
    rows = []
    for name, cv, r in fitted:
        best = tune.best_params(tune.grid_table(spark, cv, name)).first()["params"]
        rows.append((name, best, r["cv_f1"], r["accuracy"], r["weighted_f1"], r["auc_hard"],
                     r["auc"], r["base_rate"], r["n_test"]))
    return small_table(spark, rows, _SCHEMA)


def forest(spark, sf_dir):
    return _comparison(spark, tune_models(spark, sf_dir, ["random_forest"]))


def gbt(spark, sf_dir):
    return _comparison(spark, tune_models(spark, sf_dir, ["gbt"]))


def perceptron(spark, sf_dir):
    return _comparison(spark, tune_models(spark, sf_dir, ["perceptron"]))


def classifier_comparison(spark, sf_dir):
    return _comparison(spark, tune_models(spark, sf_dir))


def grid_search(spark, sf_dir):
    """Mean and spread of the CV metric for every map of every model."""
    fitted = tune_models(spark, sf_dir)
    return reduce(DataFrame.unionByName, [tune.grid_table(spark, cv, n) for n, cv, _ in fitted])


def best_params(spark, sf_dir):
    return tune.best_params(grid_search(spark, sf_dir))

"""Work side by side: every call has its own local properties; a shared pool serves searches in turn."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import functions as F

from tessera import session
from tessera.operators import models, split, tune
from tessera.plans import classifiers


class Marked:
    """Stands for an estimator, its model and an evaluator: two at a time mark their thread and read the mark."""

    def __init__(self, spark):
        self.spark, self.both = spark, Barrier(2)

    def fit(self, rows, params):
        return self

    def transform(self, rows, params):
        return params

    def evaluate(self, params):
        self.spark.sparkContext.setLocalProperty("mark", str(params))
        self.both.wait(60)
        read = self.spark.sparkContext.getLocalProperty("mark")
        self.both.wait(60)
        return float(read == str(params))

    def isLargerBetter(self):
        return True


def test_fits_side_by_side_have_their_own_properties(spark, monkeypatch):
    rows = spark.range(8).withColumn("fold", (F.col("id") % 2).cast("int"))
    monkeypatch.setattr(tune, "CrossValidatorModel", lambda model, means, sub, std: type("M", (), {
        "means": means, "_set": lambda self, **k: self})())
    marked = Marked(spark)
    found = tune.cross_validate(marked, [{"a": 1}, {"a": 2}], marked, rows, folds=2, parallelism=2, fold_col="fold")
    assert found.means == [1.0, 1.0]


def test_together_keeps_the_order_and_the_callers_properties(spark):
    spark.sparkContext.setLocalProperty("from", "caller")

    def work(i):
        return i, spark.sparkContext.getLocalProperty("from"), spark.range(i).count()

    with ThreadPoolExecutor(6) as pool:
        got = session.together(spark, pool, work, range(30))
    spark.sparkContext.setLocalProperty("from", None)
    assert got == [(i, "caller", i) for i in range(30)]


def test_a_small_table_starts_no_python_worker(spark):
    rows = [("a", 1, 2**40, 0.1, True), (None, None, None, None, None), ("b", -1, 0, float("inf"), False)]
    got = session.small_table(spark, rows, "s string, i int, l bigint, d double, b boolean")
    assert [tuple(r) for r in got.collect()] == rows and got.schema.simpleString() == "struct<s:string,i:int,l:bigint,d:double,b:boolean>"
    assert all(f.nullable for f in got.schema)
    assert "Scan" not in (plan := got._jdf.queryExecution().executedPlan().toString()) or "LocalTableScan" in plan
    assert session.small_table(spark, [], "s string").count() == 0


def test_searches_on_one_pool_are_served_in_turn(spark, tmp_path, monkeypatch):
    vectors = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: (F.rand(3) - 0.5 + i * 0).cast("float"))
    spark.range(120).select(F.col("id").alias("vec_id"), vectors.alias("embedding")) \
        .write.parquet(str(tmp_path / "embeddings.parquet"))
    pools = {}

    def recorded(est, grid, *args, pool=None, **kwargs):
        pools[type(est).__name__] = pool
        return searched(est, grid, *args, pool=pool, **kwargs)

    searched = tune.prefix_search
    monkeypatch.setattr(tune, "prefix_search", recorded)
    grids = {"random_forest": {"maxDepth": [1], "numTrees": [1]}, "gbt": {"maxDepth": [1], "maxIter": [1, 2]},
             "perceptron": {"maxIter": [2], "layers": [(3,)]}}
    found = classifiers.tune_models(spark, str(tmp_path), grids=grids, folds=2, parallelism=2)
    assert [name for name, _, _ in found] == ["random_forest", "gbt", "perceptron"]
    assert len(pools) == 3 and len(set(map(id, pools.values()))) == 1 and None not in pools.values()
    train, _, width = classifiers.prepared(spark, str(tmp_path))
    est = models.gbt(seed=classifiers.SEED)
    folded = train.withColumn("fold", split.hash_fold("vec_id", 2, classifiers.SALT + "-fold"))
    alone = searched(est, tune.param_grid(est, grids["gbt"]), folded, "label", "fold", 2)
    assert found[1][1].avgMetrics == alone.avgMetrics
    session.release(spark)


def test_models_wrap_their_trees_when_read(spark, monkeypatch):
    rows = spark.createDataFrame([(float(i % 2), Vectors.dense([i % 7, i % 2])) for i in range(40)], ["label", "features"])
    wrapped = []
    for kind in (DecisionTreeClassificationModel, DecisionTreeRegressionModel):
        monkeypatch.setattr(kind, "__init__", lambda self, java=None, kind=kind, made=kind.__init__: (wrapped.append(kind), made(self, java))[1])
    for est in (models.random_forest(seed=1).setNumTrees(3).setMaxDepth(2), models.gbt(max_iter=3)):
        model = est.fit(rows)
        copy = model.copy()
        assert copy.transform(rows).where("prediction is null").count() == 0
        cut = [models.boosted_prefix(model, 2)] if isinstance(est, models.GBTClassifier) else []
        assert not wrapped
        assert len(copy.trees) == model.getNumTrees == 3 and wrapped and all(len(m.trees) == 2 for m in cut)
        assert copy.treeWeights == model.treeWeights and copy.trees is copy.trees
        wrapped.clear()

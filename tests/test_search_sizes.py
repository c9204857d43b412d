"""A search's partitions follow the size of its rows, not the cluster; searches share a gate."""

from threading import BoundedSemaphore

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import models, split, tune
from tessera.plans import classifiers


def test_rows_of_a_search_lie_in_few_partitions(spark, tmp_path):
    vectors = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: (F.rand(3) - 0.5 + i * 0).cast("float"))
    spark.range(400).select((399 - F.col("id")).alias("vec_id"), vectors.alias("embedding")).repartition(16) \
        .write.parquet(str(tmp_path / "embeddings.parquet"))
    train, test, width = classifiers.prepared(spark, str(tmp_path))
    assert train.rdd.getNumPartitions() == test.rdd.getNumPartitions() == 1 and width == 6
    kept = [r.vec_id for part in (train, test) for r in part.collect()]
    assert len(kept) == len(set(kept)) and set(kept) <= set(range(400)) and train.count() > test.count() > 0
    rows = classifiers.PARTITION_BYTES // (8 * width)
    assert [classifiers.partitions_for(n, width) for n in (0, 1, rows, rows + 1, 10 * rows)] == [1, 1, 1, 2, 10]


def test_searches_share_a_gate(spark):
    rows = spark.range(60).select(F.col("id"), (F.col("id") % 2).cast("double").alias("label"))
    rows = VectorAssembler(inputCols=["label", "id"], outputCol="features").transform(rows) \
        .withColumn("fold", split.hash_fold("id", 2, "gate")).cache()
    est = models.random_forest(seed=1)
    grid = tune.param_grid(est, {"maxDepth": [1, 2], "numTrees": [1]})
    gate = BoundedSemaphore(1)
    gated = tune.prefix_search(est, grid, rows, "label", "fold", 2, gate=gate)
    assert gated.avgMetrics == tune.prefix_search(est, grid, rows, "label", "fold", 2).avgMetrics
    assert gate.acquire(blocking=False)  # every fit has left it
    rows.unpersist()

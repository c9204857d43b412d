"""What one task of a sized shuffle holds follows a constant, not the input."""

from pyspark.sql import functions as F

from tessera import session
from tessera.plans import ratings


def test_ratings_are_built_in_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    spark.range(2000).select((F.col("id") % 500).alias("l_orderkey"), (F.col("id") % 7).alias("l_partkey"),
                             F.lit(3.0).alias("l_quantity")).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(500).select(F.col("id").alias("o_orderkey"), (F.col("id") % 90).alias("o_custkey"),
                            F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("o_orderdate")) \
        .write.parquet(str(tmp_path / "orders.parquet"))
    whole = sorted(map(tuple, ratings.ratings(spark, str(tmp_path)).collect()))
    session.release(spark)
    monkeypatch.setattr(session, "ROWS_PER_TASK", 50)
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    before = [spark.conf.get(n) for n in names]
    sized = ratings.ratings(spark, str(tmp_path))
    assert len(sized.inputFiles()) > 2 * int(before[0])
    assert sorted(map(tuple, sized.collect())) == whole and len(whole) > 400
    assert [spark.conf.get(n) for n in names] == before
    session.release(spark)

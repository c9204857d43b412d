"""Plan-shape checks for the scale properties the operators rely on."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import ranking, rollup
from tessera.plans import claims, logs, ratings


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_limits_before_the_shuffle(spark):
    plan = _plan(logs.country_top_hosts(spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(ratings.ratings_table(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"),
                                       spark.read.parquet(f"{SF_SMALL}/orders.parquet")))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "l_extendedprice" not in plan
    plan = _plan(claims.claims_table(spark.read.parquet(f"{SF_SMALL}/orders.parquet"),
                                     spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"),
                                     spark.read.parquet(f"{SF_SMALL}/customer.parquet")))
    assert "struct<l_orderkey:bigint,l_returnflag:string>" in plan


def test_percent_rank_has_no_unpartitioned_window_over_rows(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 97).alias("t"))
    plan = _plan(ranking.percent_rank(df, "t", ranges=4))
    # the only windows are partitioned by range (or by the constant over the
    # one-row-per-range offsets table); no window without partition keys
    for line in plan.splitlines():
        if "Window [" in line and "windowspecdefinition" in line:
            assert "], [" in line, line


def test_hot_host_top_k_and_counts(spark):
    rows = [("hot.de",)] * 1000 + [(f"h{i}.de",) for i in range(2000)] + [(f"c{i % 7}.ca",) for i in range(300)]
    df = spark.createDataFrame(rows, "host string").withColumn("timestamp", F.lit(""))
    top = rollup.country_top_hosts(df, 3).filter("country_code = 'de'").orderBy("rank").collect()
    assert top[0]["host"] == "hot.de" and top[0]["count"] == 1000
    uniq = {r["country_code"]: r["unique_hosts"] for r in rollup.country_unique_hosts(df).collect()}
    assert uniq == {"de": 2001, "ca": 7, "sg": 0}


def test_shared_tables_are_pruned_scans(spark):
    plan = _plan(ratings.time_split_sizes(spark, SF_SMALL))
    assert "ReadSchema: struct<percent_rank:double>" in plan
    plan = _plan(claims.stratified_split(spark, SF_SMALL))
    assert "ReadSchema: struct<IDpol:bigint,hasClaim:int>" in plan


def test_one_scan_per_one_hot_and_semi_join_before_the_copies(spark):
    assert _plan(claims.one_hot(spark, SF_SMALL)).count("FileScan") == 1
    plan = _plan(ratings.liked_items(spark, SF_SMALL))
    assert plan.index("Generate explode") < plan.index("LeftSemi")

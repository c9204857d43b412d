import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import ranking, split


def _skewed(spark, n=3000):
    rnd = random.Random(7)
    # one key holds a third of the rows; the rest spread, with ties and a null
    rows = [(i, 500 if i % 3 == 0 else rnd.randint(0, 900)) for i in range(n)]
    rows.append((n, None))
    return spark.createDataFrame(rows, "id long, t int")


def test_percent_rank_equals_global_window(spark):
    df = _skewed(spark)
    ours = {r["id"]: r["percent_rank"] for r in ranking.percent_rank(df, "t", ranges=5).collect()}
    ref = {r["id"]: r["pr"] for r in df.withColumn("pr", F.percent_rank().over(Window.orderBy("t"))).collect()}
    assert ours == ref


def test_percent_rank_single_row(spark):
    df = spark.createDataFrame([(1, 5)], "id long, t int")
    assert ranking.percent_rank(df, "t").first()["percent_rank"] == 0.0


def test_prefix_totals_grouped(spark):
    rows = [(g, k, 1) for g in ("a", "b") for k in range(50)]
    df = spark.createDataFrame(rows, "g string, k int, v long")
    out = ranking.prefix_totals(df, "k", ["v"], group_cols=["g"], ranges=4).collect()
    assert all(r["v_before"] == r["k"] and r["v_total"] == 50 for r in out)


def test_top_k_stable_ties(spark):
    df = spark.createDataFrame([("g", "b", 3), ("g", "a", 3), ("g", "c", 1)], "g string, h string, n long")
    got = ranking.top_k(df, ["g"], [F.col("n").desc(), F.col("h").asc()], 2).orderBy("rank").collect()
    assert [r["h"] for r in got] == ["a", "b"]


def test_hash_split_disjoint_cover_and_repeatable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a, b = split.hash_split(df, "k", 0.7, "s")
    assert a.count() + b.count() == 2000
    assert a.join(b, "k").count() == 0
    a2, _ = split.hash_split(df.repartition(7), "k", 0.7, "s")
    assert sorted(r.k for r in a.collect()) == sorted(r.k for r in a2.collect())


def test_time_split_sizes_match_filters(spark):
    ranked = split.time_ranked(_skewed(spark), "t")
    sizes = {r["fraction"]: (r["train_rows"], r["test_rows"]) for r in split.split_sizes(ranked, [0.4, 0.8]).collect()}
    assert sizes[0.4][0] == ranked.filter("percent_rank < 0.4").count()
    assert sum(sizes[0.8]) == 3001


def test_train_memberships_nested(spark):
    ranked = split.time_ranked(_skewed(spark), "t")
    m = split.train_memberships(ranked, [0.4, 0.8])
    assert m.filter("split = 0.4").count() <= m.filter("split = 0.8").count()


def test_set_difference_distinct_vs_all(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    right = spark.createDataFrame([(1,)], "x int")
    assert sorted(r.x for r in split.set_difference(left, right).collect()) == [2]
    assert sorted(r.x for r in split.set_difference(left, right, keep_duplicates=True).collect()) == [1, 2]


def test_rebalance_shrinks_majority(spark):
    df = spark.createDataFrame([(i, 1.0 if i < 300 else 0.0) for i in range(1000)], "k long, label double")
    counts = {r["label"]: r["count"] for r in split.rebalance(df, "k", "label").groupBy("label").count().collect()}
    assert counts[1.0] == 300 and 200 < counts[0.0] < 400


def test_percent_rank_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "id long, t int")
    assert ranking.percent_rank(empty, "t").count() == 0
    nulls = spark.createDataFrame([(1, None), (2, None)], "id long, t int")
    assert [r["percent_rank"] for r in ranking.percent_rank(nulls, "t").collect()] == [0.0, 0.0]


def test_prefix_totals_nan_sorts_last(spark):
    rows = [(float("nan"), 1), (1.0, 1), (2.0, 1), (None, 1)]
    df = spark.createDataFrame(rows, "k double, v long")
    got = {("nan" if r["k"] != r["k"] else r["k"]): r["v_before"]
           for r in ranking.prefix_totals(df, "k", ["v"], ranges=3).collect()}
    assert got == {None: 0, 1.0: 1, 2.0: 2, "nan": 3}


def test_dense_index_contiguous_in_value_order(spark):
    big = 3_000_000_000  # beyond int: the case the index exists for
    df = spark.createDataFrame([(big + 7,), (big + 7,), (5,), (big,), (None,)], "k long")
    got = sorted((r["k"], r["i"]) for r in ranking.dense_index(df, "k", "i").collect())
    assert got == [(5, 0), (big, 1), (big + 7, 2)]


def test_dense_indices_of_two_columns_in_one_pass(spark):
    """Each column's index is its own, with keys in both, repeats, nulls and no rows."""
    big = 3_000_000_000
    rows = [(big + 7, 5), (5, 5), (big, None), (None, 9), (5, big), (5, -3)]
    df = spark.createDataFrame(rows, "a long, b long")
    out = ranking.dense_indices(df, ["a", "b"])
    assert dict(out.dtypes)["index"] == "int"
    for col in ("a", "b"):
        alone = {(r[0], r[1]) for r in ranking.dense_index(df, col, "i").collect()}
        both = [(r["key"], r["index"]) for r in out.where(out["column"] == col).collect()]
        assert len(both) == len(alone) and set(both) == alone
    assert ranking.dense_indices(df.limit(0), ["a", "b"]).count() == 0


def test_blocks_follow_the_ratings():
    from tessera.plans.ratings import BLOCK_RATINGS, MAX_BLOCKS, blocks_for
    assert [blocks_for(n) for n in (0, 1, BLOCK_RATINGS, BLOCK_RATINGS + 1, 40 * BLOCK_RATINGS)] == [1, 1, 1, 2, 40]
    assert blocks_for(10 ** 12) == MAX_BLOCKS


def test_infinite_keys_and_zoneless_times_rank(spark):
    from tessera.operators.ranking import percent_rank
    from tessera.operators.split import time_ranked
    keys = [float("-inf"), float("inf"), 1.0, 2.0, 3.0, 4.0, 5.0, float("inf")]
    frame = spark.createDataFrame([(k,) for k in keys], "k double")
    out = sorted((r[0], r[1]) for r in percent_rank(frame, "k", ranges=8).collect())
    assert [x for _, x in out] == [0, 1 / 7, 2 / 7, 3 / 7, 4 / 7, 5 / 7, 6 / 7, 6 / 7]
    times = spark.sql("select timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(id) t from range(5)")
    assert sorted(r[1] for r in time_ranked(times, "t").collect()) == [0, 0.25, 0.5, 0.75, 1]


def test_vectors_of_any_one_length(spark):
    import pytest

    from tessera.sources.standins import collision_features
    frame = spark.createDataFrame([(1, [0.5] * 70, 3)], "vec_id long, embedding array<float>, label int")
    assert len(collision_features(frame).columns) == 72
    mixed = frame.unionAll(spark.createDataFrame([(2, [0.5] * 5, 3)], frame.schema))
    with pytest.raises(ValueError):
        collision_features(mixed)


def test_large_factorisations_exchange_little(spark):
    """Sixty times sf0.1 (28.8 million training ratings): a key's factors go to few
    blocks, no step's files outlive the next, and fits do not add up."""
    from tessera.operators import models
    from tessera.plans.ratings import blocks_for, fits_at_once
    assert blocks_for(28_800_000) <= 12
    assert models.als().getCheckpointInterval() == 1
    assert [fits_at_once(n, 6) for n in (0, 480_000, 36_000_000, 10 ** 12)] == [6, 6, 2, 1]

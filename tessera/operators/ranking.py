"""Exact distributed ranking: top-k per group, prefix totals, percent rank.

None of these sends a whole table, group or key to one task. A global order
is cut into key ranges at quantile cut points of the distinct keys; only one
row per range is ever handled in a single window, and that table is bounded
by the number of ranges, not by the data.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions, stored


def top_k(df: DataFrame, group_cols: list[str], order: list[Column], k: int,
          rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k within each group by ``order`` (make it total for stable ties).

    ``row_number() <= k`` lets Catalyst put a partial group limit before the
    shuffle (WindowGroupLimit), so a hot group sends at most k rows per map
    partition, never all its rows.
    """
    if not group_cols:
        # Global top-k: each partition keeps its k best, then one merge of
        # k x partitions rows (TakeOrderedAndProject); only k rows are ranked.
        best = df.orderBy(*order).limit(k)
        return best.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def key_cut_points(keyed: DataFrame, key: str, ranges: int) -> list[float]:
    """About ``ranges - 1`` cut points splitting the distinct keys evenly
    (quantiles of the key over one row per key, so a hot key weighs one).
    The list is bounded by ``ranges``, whatever the data size."""
    if ranges <= 1:
        return []
    k = F.col(key).cast("double")
    probs = [i / ranges for i in range(1, ranges)]
    cuts = keyed.select(k.alias("_k")).where(F.col("_k").isNotNull() & ~F.isnan("_k") & (F.abs("_k") != float("inf"))) \
        .approxQuantile("_k", probs, 0.25 / ranges)
    return sorted(set(cuts))


def with_key_range(keyed: DataFrame, key: str, cuts: list[float], out_col: str = "_range") -> DataFrame:
    """Range index of each key: -1 for null, then one range per gap between
    cut points (a key equal to a cut starts the next range), NaN last. A pure
    function of the key, so every branch and every retried task agrees."""
    if not cuts:
        return keyed.withColumn(out_col, F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.lit(0)))
    splits = [float("-inf"), *cuts, float("inf")]
    with_k = keyed.withColumn("_k", F.col(key).cast("double"))
    bucketed = Bucketizer(splits=splits, inputCol="_k", outputCol="_b", handleInvalid="keep").transform(with_k)
    return bucketed.withColumn(out_col, F.coalesce(F.col("_b").cast("int"), F.lit(-1))).drop("_k", "_b")


def prefix_totals(keyed: DataFrame, key: str, value_cols: list[str],
                  group_cols: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """For each distinct numeric ``key`` (ascending, nulls first), within each
    group if ``group_cols`` are given, add ``<v>_before``, the sum of ``v``
    over all smaller keys, and ``<v>_total``, the sum over all keys.

    ``keyed`` must hold one row per (group, key). Steps: cut the key domain
    into ranges of about equal numbers of distinct keys (so a big group spans
    many ranges), total each (group, range) pair, running offsets over those
    few rows, then a running sum inside each range plus its offset.
    """
    g = list(group_cols or [])
    spark = keyed.sparkSession
    n = ranges or shuffle_partitions(spark)
    # The per-key table is read three times (cut points, range totals, the
    # running sums); cut it once so the plan behind it runs once.
    keyed = stored(keyed, "rank-keys")
    ranged = with_key_range(keyed, key, key_cut_points(keyed, key, n))
    per_range = ranged.groupBy(*g, "_range").agg(*[F.sum(v).alias(f"_r_{v}") for v in value_cols])
    by_group = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    before = by_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = by_group.orderBy("_range").rowsBetween(Window.unboundedPreceding,
                                                        Window.unboundedFollowing)
    offsets = per_range.select(
        *g, "_range",
        *[F.coalesce(F.sum(f"_r_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in value_cols],
        *[F.sum(f"_r_{v}").over(everything).alias(f"{v}_total") for v in value_cols])
    inside = Window.partitionBy(*g, "_range").orderBy(F.col(key).asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    if g:
        # At most ranges x groups rows; AQE broadcasts it when it measures small.
        out = ranged.join(offsets, g + ["_range"])
    else:
        # One row per range: bounded by ``n``, not by the data.
        out = ranged.join(F.broadcast(offsets), "_range")
    return out.select(
        *keyed.columns,
        *[(F.col(f"_off_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"{v}_before")
          for v in value_cols],
        *[F.col(f"{v}_total") for v in value_cols])


def percent_rank(df: DataFrame, key: str, out_col: str = "percent_rank",
                 ranges: int | None = None) -> DataFrame:
    """``percent_rank()`` over a global ascending order of ``key``, computed exactly
    without a single-partition window.

    rank - 1 = rows with a smaller key, so only per-key counts need ordering;
    a hot key collapses to one row before any shuffle. The rank table is joined
    back on the key (AQE splits a skewed key's partition on the big side).
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    ranks = prefix_totals(counts, key, ["_n"], ranges=ranges)
    pr = F.when(F.col("_n_total") > 1,
                F.col("_n_before").cast("double") / (F.col("_n_total") - 1)).otherwise(F.lit(0.0))
    ranks = ranks.select(F.col(key).alias("_rank_key"), pr.alias(out_col))
    joined = df.join(ranks, df[key].eqNullSafe(ranks["_rank_key"]))
    return joined.drop("_rank_key")


def dense_index(df: DataFrame, col: str, out_col: str) -> DataFrame:
    """``(col, out_col)``: a contiguous 0-based int for each distinct non-null
    value, in value order, computed with the distributed prefix totals (no
    driver-side numbering, no single task). For keys that must fit in int,
    such as matrix-factorisation ids over bigint keys."""
    ids = df.select(F.col(col)).where(F.col(col).isNotNull()).distinct().withColumn("_one", F.lit(1))
    numbered = prefix_totals(ids, col, ["_one"])
    return numbered.select(col, F.col("_one_before").cast("int").alias(out_col))


def dense_indices(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, key, index)``: the dense index of each of several bigint
    columns, all from one scan of ``df`` and one set of prefix totals."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("key")) for c in cols])
    keys = df.select(F.explode(each).alias("k")).select("k.*").where(F.col("key").isNotNull()) \
        .distinct().withColumn("_one", F.lit(1))
    numbered = prefix_totals(keys, "key", ["_one"], ["column"])
    return numbered.select("column", "key", F.col("_one_before").cast("int").alias("index"))

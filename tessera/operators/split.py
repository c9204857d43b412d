"""Splits and samples: time-ordered, key-hash, stratified, seeded; set difference;
class balance. Hash splits depend only on a row key and a salt, so they are
the same on any partitioning, re-run or engine; the seeded forms are kept for
parity with ``sampleBy`` / ``randomSplit`` / ``sample``."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import percent_rank

HASH_BITS = 60
ROWS_PER_BIN = 4096
MAX_BIN_BITS = 20


def hash_uniform(key: Column | str, salt: str = "") -> Column:
    """A number in [0, 1) from the first 8 hex digits of ``md5(salt || key)``."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(salt), k.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def hash_order(*keys: Column | str, salt: str = "") -> Column:
    """Uniform integer in [0, 2^60): the first 15 hex digits of ``md5(salt ||
    keys joined by colons)``, null keys left out. 60 bits, so rows of even a very large table rarely tie."""
    cols = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.concat_ws(":", *cols))), 1, 15), 16, 10).cast("bigint")


def hash_fold(key: Column | str, folds: int, salt: str = "") -> Column:
    """Fold 0 to ``folds`` - 1 of a row, by key hash."""
    return F.floor(hash_uniform(key, salt) * folds).cast("int")


def hash_split(df: DataFrame, key: str, fraction: float, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """(part, rest): rows whose key hashes below ``fraction``, and the others."""
    u = hash_uniform(key, salt)
    return df.filter(u < fraction), df.filter(u >= fraction)


def stratified_hash_split(df: DataFrame, key: str, label: str, fractions: dict,
                          salt: str = "") -> tuple[DataFrame, DataFrame]:
    """Per-class fractions on a key hash; the complement is the test part, so
    no set difference (and no shuffle) is needed to build it."""
    frac = None
    for cls, f in fractions.items():
        cond = F.col(label) == F.lit(cls)
        frac = F.when(cond, F.lit(float(f))) if frac is None else frac.when(cond, F.lit(float(f)))
    frac = frac.otherwise(F.lit(0.0))
    u = hash_uniform(key, salt)
    return df.filter(u < frac), df.filter(u >= frac)


def split_label(df: DataFrame, key: str, label: str, fractions: dict, salt: str = "",
                out_col: str = "part") -> DataFrame:
    """The stratified hash split as a column: ``train`` or ``test``."""
    frac = F.lit(0.0)
    for cls, f in fractions.items():
        frac = F.when(F.col(label) == F.lit(cls), F.lit(float(f))).otherwise(frac)
    u = hash_uniform(key, salt)
    return df.withColumn(out_col, F.when(u < frac, F.lit("train")).otherwise(F.lit("test")))


def stratified_sample(df: DataFrame, label: str, fractions: dict, seed: int) -> DataFrame:
    """Seeded per-class Bernoulli sample (``sampleBy``); moves with partitioning."""
    return df.sampleBy(label, fractions, seed)


def seeded_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(False, fraction, seed)


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    return df.randomSplit(weights, seed)


def set_difference(left: DataFrame, right: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """Rows of ``left`` not in ``right``: distinct (EXCEPT) or multiset (EXCEPT ALL).

    Both shuffle both inputs on every column; when rows carry a key, prefer
    ``left.join(right, key, 'left_anti')`` or the complement of a hash split.
    """
    return left.exceptAll(right) if keep_duplicates else left.subtract(right)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Per class: rows, share, balanced weight n / (k * n_c), and the fraction
    of the class to keep so every class shrinks to the smallest one."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per class: a small table whose totals ride along as window sums.
    every = Window.partitionBy(F.lit(0))
    return counts.select(
        label, "n",
        (F.col("n") / F.sum("n").over(every)).alias("fraction"),
        (F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))).alias("weight"),
        (F.min("n").over(every) / F.col("n")).alias("keep_fraction"))


def with_class_weight(df: DataFrame, label: str, out_col: str = "weight") -> DataFrame:
    """Attach the balanced class weight to each row (for ``weightCol``)."""
    weights = class_counts(df, label).select(label, F.col("weight").alias(out_col))
    # One row per class value; Spark broadcasts it if it measures small.
    return df.join(weights, label)


def rebalance(df: DataFrame, key: str, label: str, salt: str = "") -> DataFrame:
    """Shrink every class to exactly the size of the smallest, by key hash
    (repeatable); the minority class is kept whole."""
    smallest = df.groupBy(label).count().agg(F.min("count")).first()[0] or 0
    return smallest_hashes(df, [key], [label], lambda *_: F.lit(smallest), salt)


def exact_stratified_sample(df: DataFrame, key: str, label: str, fractions: dict, salt: str = "") -> DataFrame:
    """Of each class exactly ``floor(fraction * rows)`` rows, by key hash; classes
    without a fraction go."""
    known = df.where(F.col(label).isin(list(fractions)))
    kind = df.schema[label].dataType

    def size(rows: Column, cls: Column) -> Column:
        share = F.lit(0.0)
        for value, f in fractions.items():
            share = F.when(cls == F.lit(value).cast(kind).cast("string"), F.lit(float(f))).otherwise(share)
        return F.floor(rows * share)

    return smallest_hashes(known, [key], [label], size, salt)


def exact_sample(df: DataFrame, keys: list[str], fraction: float, salt: str = "") -> DataFrame:
    """Exactly ``floor(fraction * rows)`` rows, by key hash."""
    return smallest_hashes(df, keys, [], lambda rows, _: F.floor(rows * fraction), salt)


def rebalance_seeded(df: DataFrame, label: str, seed: int) -> DataFrame:
    """``sampleBy`` with each class's keep fraction (min / n, never above 1)."""
    rows = class_counts(df, label).select(label, "keep_fraction").collect()
    return df.sampleBy(label, {r[0]: float(min(1.0, r[1])) for r in rows}, seed)


def smallest_hashes(df: DataFrame, keys: list[str], group_cols: list[str], size: Callable[..., Column],
                    salt: str = "", rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Exactly ``size(rows of the group, group as text ..)`` rows of each group,
    those with the smallest key hashes (ties by the keys); without ``group_cols``
    of the whole table. A null group is a group; a size beyond the group's rows
    takes all.

    Hashes are counted in bins of equal width, per group; a running sum over
    the bins finds the one in which the last hash taken lies. Rows of lower bins
    are taken, rows of that bin (the wait list, about ``rows_per_bin``) are
    ranked among themselves, and no other row is sorted or moved. One row per
    group is broadcast, so groups are meant to be classes, not keys. Rows that
    repeat all keys share a hash and are told apart arbitrarily.
    """
    own = "_"
    while any(c.lower().startswith(own) for c in df.columns):
        own += "_"
    g = [f"{own}g{i}" for i in range(len(group_cols) or 1)]
    hash_col, bin_col, cut_col, rank_col = (own + name for name in ("hash", "bin", "cut", "rank"))
    groups = [F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in group_cols] or [F.lit("")]
    named = df.withColumns(dict(zip(g, groups, strict=True))).withColumn(hash_col, hash_order(*keys, salt=salt))
    counts = named.groupBy(*g).agg(F.count(F.lit(1)).alias("_rows"))
    largest = counts.agg(F.max("_rows")).first()[0] or 0
    bits = min(MAX_BIN_BITS, max(0, math.ceil(math.log2(max(1, largest / rows_per_bin)))))
    hashed = named.withColumn(bin_col, F.shiftright(hash_col, HASH_BITS - bits).cast("int"))
    bins = hashed.groupBy(*g, bin_col).agg(F.count(F.lit(1)).alias("_rows"))
    so_far = Window.partitionBy(*g).orderBy(bin_col)
    bins = bins.select(*g, F.col(bin_col).alias("_bin"), F.sum("_rows").over(so_far).alias("_upto"), "_rows",
                       F.sum("_rows").over(Window.partitionBy(*g)).alias("_all")) \
        .withColumn("_size", size(F.col("_all"), *[F.col(c) for c in g]).cast("bigint"))
    # The first bin that holds enough; none if the whole group is taken.
    enough = F.when(F.col("_upto") >= F.col("_size"),
                    F.struct("_bin", (F.col("_size") - F.col("_upto") + F.col("_rows")).alias("left")))
    cuts = bins.groupBy(*g).agg(F.min(enough).alias(cut_col))
    cut = F.col(cut_col)
    placed = hashed.join(F.broadcast(cuts), g)
    certain = placed.where(cut.isNull() | (F.col(bin_col) < cut["_bin"]))
    rank = F.row_number().over(Window.partitionBy(*g).orderBy(hash_col, *keys))
    waiting = placed.where(F.col(bin_col) == cut["_bin"]).withColumn(rank_col, rank) \
        .where(F.col(rank_col) <= cut["left"]).drop(rank_col)
    return certain.unionByName(waiting).select(*df.columns)


def time_ranked(df: DataFrame, time_col: str) -> DataFrame:
    """Add the exact global ``percent_rank`` by time (ties share a rank).
    Timestamps, with or without zone, are ranked as exact microseconds."""
    if not df.schema[time_col].dataType.simpleString().startswith("timestamp"):
        return percent_rank(df, time_col)
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    return percent_rank(df.withColumn("_micros", micros), "_micros").drop("_micros")


def time_split(ranked: DataFrame, fraction: float, rank_col: str = "percent_rank") -> tuple[DataFrame, DataFrame]:
    """(train, test): percent rank below ``fraction``, and the rest."""
    return ranked.filter(F.col(rank_col) < fraction), ranked.filter(F.col(rank_col) >= fraction)


def train_memberships(ranked: DataFrame, fractions: list[float], rank_col: str = "percent_rank",
                      out_col: str = "split") -> DataFrame:
    """One row per (row, training split that contains it): all time splits in a
    single pass instead of one re-computed plan per split."""
    arr = F.array(*[F.lit(float(f)) for f in fractions])
    return ranked.withColumn(out_col, F.explode(F.filter(arr, lambda f: F.col(rank_col) < f)))


def split_sizes(ranked: DataFrame, fractions: list[float], rank_col: str = "percent_rank") -> DataFrame:
    """Train and test row counts for each fraction, from one aggregate."""
    aggs = []
    for i, f in enumerate(fractions):
        aggs.append(F.count_if(F.col(rank_col) < f).alias(f"tr{i}"))
        aggs.append(F.count_if(F.col(rank_col) >= f).alias(f"te{i}"))
    row = ranked.agg(*aggs)
    parts = [F.struct(F.lit(float(f)).alias("fraction"), F.col(f"tr{i}").alias("train_rows"),
                      F.col(f"te{i}").alias("test_rows")) for i, f in enumerate(fractions)]
    return row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")

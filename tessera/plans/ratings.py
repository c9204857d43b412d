"""Ratings: time-ordered splits, matrix-factorisation error by split and
setting, user segments, the largest segment's liked items and top tags."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cuts, metrics, models, ranking, segments, split, tags
from ..session import ensure_checkpoint_dir, materialized, shared, sized_shuffles, small_table, stored, together
from ..sources.files import table
from ..sources.standins import movies_table, ratings_table, segments_table

FRACTIONS = [0.4, 0.6, 0.8]
SEED = 17
SAMPLE_FRACTION = 0.1
# Ratings in a user or item block of a factorisation. Each half-step sends a
# key's factors once to every block that holds one of its ratings, so what is
# shuffled grows with the number of blocks; a block is as large as one task
# holds at ease (12 bytes a rating, and the factors met). Blocks take part in
# the result, so their number follows the table and not the cluster; beyond
# MAX_BLOCKS, each holds more ratings.
BLOCK_RATINGS = 5_000_000
MAX_BLOCKS = 2_000
# Blocks of all fits under way at once, of which each has its ratings in memory
# and its last steps' shuffle files on disk.
BLOCKS_AT_ONCE = 16
# The two factorisation settings of the analysis.
SETTINGS = {
    "setting1": {"rank": 10, "max_iter": 10, "reg_param": 0.1},
    "setting2": {"rank": 20, "max_iter": 15, "reg_param": 0.01},
}
CLUSTERS = 25


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per (user, item), materialised once: the rank counts, the
    ranked rows and every split read it."""
    def build():
        lines = table(spark, sf_dir, "lineitem")
        with sized_shuffles(spark, lines.count()):
            return stored(ratings_table(lines, table(spark, sf_dir, "orders")), "ratings")
    return shared(spark, "ratings", sf_dir, build)


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings with their exact global percent rank by time, materialised once:
    every split, model and liked-item query filters it."""
    return materialized(spark, "ranked-ratings", sf_dir,
                        lambda: split.time_ranked(ratings(spark, sf_dir), "timestamp"))


def exact_sample(spark, sf_dir):
    """Exactly a tenth of the ratings (rounded down), by key hash."""
    data = ratings(spark, sf_dir).select("userId", "movieId")
    return split.exact_sample(data, ["userId", "movieId"], SAMPLE_FRACTION, "ratings")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movies_table(table(spark, sf_dir, "part"))


def time_percent_rank(spark, sf_dir):
    return ranked(spark, sf_dir)


def time_split_sizes(spark, sf_dir):
    return split.split_sizes(ranked(spark, sf_dir), FRACTIONS)


def time_cuts(spark, sf_dir):
    """``time_split_sizes`` from the exact cuts alone: no row is ranked."""
    data = ratings(spark, sf_dir)
    return cuts.cut_sizes(data, cuts.rank_cuts(data, "timestamp", FRACTIONS))


def _segment_liked(spark, sf_dir):
    """Liked items of the largest market segment in every training split, all
    splits in one plan (each rating row joins the splits that contain it)."""
    members = segments.largest_cluster_members(segments_table(table(spark, sf_dir, "customer")))
    # The members are the same in every split: keep their good ratings first,
    # then copy those into the splits.
    good = segments.good_ratings(ranked(spark, sf_dir), members)
    return segments.items_liked(split.train_memberships(good, FRACTIONS), group_cols=["split"])


def liked_items(spark, sf_dir):
    liked = _segment_liked(spark, sf_dir)
    return liked.select("split", "movieId", F.round("average_rating", 6).alias("average_rating"),
                        "n_ratings")


def top_tags_rows(spark, sf_dir):
    return tags.top_tags_rows(_segment_liked(spark, sf_dir), movies(spark, sf_dir), 10, ["split"])


def top_tags_items(spark, sf_dir):
    return tags.top_tags_items(_segment_liked(spark, sf_dir), movies(spark, sf_dir), 10, ["split"])


def tag_indicators(spark, sf_dir):
    """Per item, each distinct tag once (the indicator table in long form)."""
    return tags.tag_indicators(movies(spark, sf_dir))


def _index(spark, sf_dir, col: str, out_col: str) -> DataFrame:
    """Dense int index of a bigint key; users' and items' are built together,
    once per application."""
    both = materialized(spark, "indices", sf_dir,
                        lambda: ranking.dense_indices(ratings(spark, sf_dir), ["userId", "movieId"]))
    return both.where(F.col("column") == col).select(F.col("key").alias(col), F.col("index").alias(out_col))


def _ranked_input(spark, sf_dir) -> DataFrame:
    """Ranked ratings with int user / item ids for the factorisation (ALS
    needs int ids; the keys are bigint, so they are always indexed densely and
    the model depends on the keys' order only). Ratings without a user or item
    take no part. Built once per application."""
    def build():
        base = ranked(spark, sf_dir).select("userId", "movieId", "rating", "percent_rank")
        return base.join(_index(spark, sf_dir, "userId", "user"), "userId") \
            .join(_index(spark, sf_dir, "movieId", "item"), "movieId")
    return materialized(spark, "als-input", sf_dir, build)


def _factor_keys(spark, sf_dir, factors: DataFrame) -> DataFrame:
    """Factor rows keyed by the original user key instead of the ALS id."""
    users = _index(spark, sf_dir, "userId", "user")
    return factors.join(users, factors["id"] == users["user"]) \
        .select(F.col("userId").alias("id"), "features")


def blocks_for(n_ratings: int, per_block: int = BLOCK_RATINGS) -> int:
    """User and item blocks of a factorisation of so many ratings."""
    return min(MAX_BLOCKS, max(1, -(-n_ratings // per_block)))


def als_model(spark, sf_dir, fraction: float, setting: str):
    """The factorisation of one split's training ratings under one setting.
    Seeded, so it is fitted once per application and shared by the error
    table and the user clustering."""
    def fit():
        s = SETTINGS[setting]
        train, _ = split.time_split(_ranked_input(spark, sf_dir), fraction)
        ensure_checkpoint_dir(spark)
        return models.als(user="user", item="item", seed=SEED, rank=s["rank"], max_iter=s["max_iter"],
                          reg_param=s["reg_param"], blocks=blocks_for(train.count())).fit(train)

    return shared(spark, f"als {fraction} {setting}", sf_dir, fit)


def fits_at_once(n_ratings: int, fits: int) -> int:
    """How many of so many fits of at most ``n_ratings`` run together: small
    ones all, so that short steps leave no core idle; large ones, which keep a
    cluster busy by themselves, few, so that their files do not add up."""
    return max(1, min(fits, BLOCKS_AT_ONCE // blocks_for(n_ratings)))


def als_errors(spark, sf_dir, settings: list[str] | None = None, concurrency: int = 6):
    """RMSE / MSE / MAE of each setting on each time split, with the share of
    test ratings the model could score (cold-start rows are dropped).

    The six fits are independent distributed jobs; ``fits_at_once`` of them,
    at most ``concurrency``, run together."""
    names = settings or list(SETTINGS)
    data = _ranked_input(spark, sf_dir)
    at_once = fits_at_once(data.count(), concurrency)

    def one(job):
        f, name = job
        s = SETTINGS[name]
        _, test = split.time_split(data, f)
        scored = als_model(spark, sf_dir, f, name).transform(test)
        m = metrics.regression_metrics(scored, "rating").first()
        n_test = test.count()
        return (f, name, s["rank"], s["max_iter"], s["reg_param"], float(m["rmse"]),
                float(m["mse"]), float(m["mae"]), int(m["n"]), n_test,
                float(m["n"]) / n_test if n_test else None)

    jobs = [(f, name) for f in FRACTIONS for name in names]
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        rows = together(spark, pool, one, jobs)
    schema = ("split double, setting string, rank int, max_iter int, reg_param double, rmse double, "
              "mse double, mae double, n_scored bigint, n_test bigint, covered double")
    return small_table(spark, rows, schema)


def _split_clusters(spark, sf_dir, setting: str = "setting2"):
    """For each split: the user factors of its factorisation, clustered.
    Seeded; written once per application and state of the inputs."""
    def build():
        # Builds the shared input before the threads start.
        at_once = fits_at_once(_ranked_input(spark, sf_dir).count(), len(FRACTIONS))

        def one(f):
            factors = _factor_keys(spark, sf_dir, als_model(spark, sf_dir, f, setting).userFactors)
            return segments.cluster_factors(factors, CLUSTERS, SEED).withColumn("split", F.lit(f))

        with ThreadPoolExecutor(max_workers=at_once) as pool:
            return reduce(DataFrame.unionByName, together(spark, pool, one, FRACTIONS))

    return materialized(spark, f"clusters-{setting}", sf_dir, build)


def user_clusters(spark, sf_dir):
    """Five largest user clusters per split."""
    return segments.cluster_sizes(_split_clusters(spark, sf_dir), 5, ["split"])


def cluster_top_tags(spark, sf_dir):
    """Largest cluster's liked items and their top tags, both counting forms."""
    clusters = _split_clusters(spark, sf_dir)
    members = segments.largest_cluster_members(clusters, ["split"])
    train = split.train_memberships(ranked(spark, sf_dir), FRACTIONS)
    liked = segments.liked_items(train, members, group_cols=["split"])
    return tags.top_tags_both(liked, movies(spark, sf_dir), 10, ["split"])


def als_coverage(spark, sf_dir):
    """Per split: test ratings, those the factorisation could score (its user
    and item both occur in the train part), and their share."""
    return als_errors(spark, sf_dir, settings=["setting1"]).select(
        F.col("split"), "n_test", "n_scored", F.round("covered", 6).alias("covered"))


def model_chart_series(spark, sf_dir):
    """Chart-ready ``(series, x, y)`` of the factorisation: each error measure
    by split and setting, and the sizes of the five largest user clusters."""
    measures = ["rmse", "mse", "mae"]
    errors = als_errors(spark, sf_dir)
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("y")) for m in measures]))
    errors = errors.select("split", "setting", pairs.alias("p")).select(
        F.concat_ws(":", "p.m", "setting").alias("series"), F.col("split").cast("string").alias("x"), F.col("p.y").alias("y"))
    sizes = user_clusters(spark, sf_dir).select(
        F.concat(F.lit("cluster_size:"), F.col("split").cast("string")).alias("series"),
        F.col("rank").cast("string").alias("x"), F.col("size").cast("double").alias("y"))
    return errors.unionByName(sizes)

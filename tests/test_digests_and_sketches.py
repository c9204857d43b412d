"""Digest difference, exact cuts by sketches, daily sketches, bucket totals and sparse vectors against the plain forms."""

import random
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.operators import cuts, digest, rollup, sketches, split
from tessera.operators.features import vector_entries

ROWS = [(1, "a", 1.0), (1, "a", 1.0), (1, "a", 1.0), (2, None, 0.0), (2, None, -0.0), (None, "b", float("nan")),
        (3, "c", 2.0), (4, "d", 3.0), (4, "d", 3.0), (None, None, None)]
GONE = [(1, "a", 1.0), (2, None, 0.0), (None, "b", float("nan")), (9, "z", 0.0), (None, "c", None), (None, None, None)]


def _counted(df):
    return Counter(map(repr, map(tuple, df.withColumn("x", F.col("x") + 0.0).collect())))


@pytest.mark.parametrize("keep", [False, True])
@pytest.mark.parametrize("collide", [False, True])
def test_digest_difference_equals_except(spark, keep, collide):
    """Nulls, zeros of both signs, NaN, repeats; one digest for all rows."""
    left = spark.createDataFrame(ROWS, "n int, s string, x double")
    right = spark.createDataFrame(GONE, "m long, t string, y double")
    digests = {"digest": lambda _: F.lit(7).cast("bigint")} if collide else {}
    empty = right.limit(0)
    for other in (right, empty):
        ours = digest.digest_difference(left, other, keep, **digests)
        plain = left.exceptAll(other) if keep else left.subtract(other)
        assert _counted(ours) == _counted(plain) and ours.columns == plain.columns
    assert digest.digest_difference(left.limit(0), right, keep).count() == 0


def test_digest_difference_with_a_crowded_field(spark):
    """Far more digests than bits: rows that share bits are compared, none is lost."""
    left = spark.range(60_000).select((F.col("id") % 50_000).alias("k"))
    right = spark.range(0, 100_000, 2).select(F.col("id").alias("k"))
    for bits in (digest.MIN_BITS, digest.MAX_BITS):
        for keep in (False, True):
            out = digest.digest_difference(left, right, keep, max_bits=bits)
            expected = left.exceptAll(right) if keep else left.subtract(right)
            assert out.count() == expected.count() and out.agg(F.sum("k")).first() == expected.agg(F.sum("k")).first()


def shuffled(df):
    """Bytes written to the shuffles of the plan after it ran, digests excluded."""
    df.collect()
    seen, waiting, total = set(), [df._jdf.queryExecution().executedPlan()], 0
    while waiting:
        plan = waiting.pop()
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            waiting.append(plan.executedPlan())
        elif name.endswith("QueryStage"):
            waiting.append(plan.plan())
        elif name == "Exchange" and plan.id() not in seen:
            seen.add(plan.id())
            total += plan.metrics().apply("shuffleBytesWritten").value()
        children = plan.children()
        waiting += [children.apply(i) for i in range(children.length())]
    return total


def test_rows_without_an_equal_are_not_moved(spark):
    """Of 20,000 wide rows about a hundred meet an equal; the plan's shuffles
    carry those, digests and the field, below a tenth of the plain difference."""
    wide = F.concat(*[F.sha2(F.concat(F.lit(i), F.col("k")), 512) for i in range(4)]).alias("text")
    left = spark.range(20_000).select(F.col("id").alias("k")).select("k", wide)
    right = spark.range(19_900, 40_000).select(F.col("id").alias("k")).select("k", wide)
    out = digest.digest_difference(left, right, keep_duplicates=True)
    assert out.count() == 19_900 and shuffled(out) * 10 < shuffled(left.exceptAll(right))


def _by_ranks(df, key, fractions):
    ranked = split.time_ranked(df, key)
    return {r.fraction: (r.train_rows, r.test_rows) for r in split.split_sizes(ranked, fractions).collect()}


@pytest.mark.parametrize("wait", [1, 10 ** 6])
def test_cuts_equal_ranks(spark, wait):
    """A value held by a third of all rows, ties, nulls, far-off values."""
    rnd = random.Random(3)
    rows = [(None,)] * 40 + [(500,)] * 700 + [(rnd.randint(-900, 900),) for _ in range(1300)] + [(2 ** 62,), (-2 ** 62,)]
    df = spark.createDataFrame(rows, "t long")
    fractions = [0.0, 0.005, 0.019, 0.02, 0.3, 0.4, 0.6, 0.8, 0.9999, 1.0]
    found = cuts.rank_cuts(df, "t", fractions, wait_rows=wait)
    sizes = {r.fraction: (r.train_rows, r.test_rows) for r in cuts.cut_sizes(df, found).collect()}
    assert sizes == _by_ranks(df, "t", fractions)
    for c in found:
        assert df.where(cuts.first_part(F.col("t"), c)).count() == c.rows


def test_cuts_of_small_tables(spark):
    for rows in ([], [(5,)], [(None,)], [(None,), (None,)], [(5,), (5,)], [(None,), (1,)]):
        df = spark.createDataFrame(rows, "t long")
        sizes = {c.fraction: (c.rows, c.total - c.rows) for c in cuts.rank_cuts(df, "t", [0.4, 1.0], wait_rows=1)}
        expected = _by_ranks(df, "t", [0.4, 1.0]) if rows else {0.4: (0, 0), 1.0: (0, 0)}
        assert sizes == expected, rows


def _logs(spark, n=6000):
    host = F.when(F.col("id") % 3 == 0, F.lit("h0.de")).otherwise(F.concat(
        F.lit("h"), (F.col("id") * F.col("id") % 1999).cast("string"), F.element_at(
            F.array(F.lit(".de"), F.lit(".ca"), F.lit(".fr")), (F.col("id") % 3 + 1).cast("int"))))
    day = F.lpad((F.col("id") % 32).cast("string"), 2, "0")
    return spark.range(n).select(host.alias("host"), F.concat(day, F.lit("/Jan/2024:01:00:00 -0400")).alias("timestamp"))


@pytest.mark.parametrize("buckets, probes", [(1, 1), (512, 1), (1 << 16, 8)])
def test_top_hosts_by_buckets_equal_the_plain_rollup(spark, buckets, probes):
    """One bucket forces the count of all hosts."""
    logs = _logs(spark)
    for k in (9, 5000):
        plain = sorted(rollup.country_top_hosts(logs, k).collect())
        assert sorted(sketches.country_top_hosts(logs, k, buckets=buckets, probes=probes).collect()) == plain


def test_buckets_rule_out_most_hosts(spark):
    busy = spark.range(900).select(F.concat(F.lit("busy"), (F.col("id") % 9).cast("string"), F.lit(".de")).alias("host"))
    hosts = busy.unionByName(spark.range(5000).select(F.concat(F.col("id").cast("string"), F.lit(".de")).alias("host"))) \
        .select(F.lit("de").alias("country_code"), "host", F.pmod(F.xxhash64("host"), F.lit(4096)).alias("bucket"))
    assert 1 <= sketches.candidate_buckets(hosts, 9).count() <= 9
    assert sketches.candidate_buckets(hosts, 9_000).count() == hosts.select("bucket").distinct().count()


def test_sketches_of_any_period(spark):
    logs = _logs(spark, 40_000)
    periods = spark.createDataFrame([(a, b) for a in (1, 5, 30) for b in (5, 17, 31) if a <= b], "from_day int, to_day int")
    out = sketches.checked_unique_hosts(logs, periods).collect()
    assert len(out) == 14 and all(r.within_error for r in out)
    days = sketches.host_sketches(logs)
    assert days.groupBy("country_code").count().agg(F.max("count")).first()[0] == 31
    assert not sketches.checked_unique_hosts(logs.limit(0), periods).collect()


def test_vector_entries(spark):
    rows = [(1, Vectors.sparse(1_000_000, [3, 999_999], [2.0, -1.0])), (2, Vectors.dense([0.0, 5.0])), (3, None),
            (4, Vectors.sparse(7, [], [])), (5, Vectors.sparse(7, [2], [0.0])), (6, Vectors.dense([]))]
    got = sorted(map(tuple, vector_entries(spark.createDataFrame(rows, ["id", "v"]), "id", "v").collect()))
    assert got == [(1, 3, 2.0, 1_000_000), (1, 999_999, -1.0, 1_000_000), (2, 1, 5.0, 2)]

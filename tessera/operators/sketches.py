"""Unique hosts of any period from small mergeable sketches, and top hosts
found through bucket totals, beside the exact rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.logparse import day_of
from ..session import stored
from .ranking import top_k
from .rollup import COUNTRIES, country_spine, with_country

LG_K = 14  # registers of a sketch, as a power of two: 16,384
ERRORS = 4  # standard errors allowed

BUCKETS = 1 << 16
PROBES = 8  # buckets looked into first, per host wanted


def relative_error(lg_k: int = LG_K) -> float:
    """Bound of a union's estimate in ``ERRORS`` standard errors of 1.04 / sqrt(registers)."""
    return ERRORS * 1.04 / (1 << lg_k) ** 0.5


def host_sketches(logs: DataFrame, countries: dict[str, str] | None = None, lg_k: int = LG_K) -> DataFrame:
    """``country_code, day, sketch``: distinct hosts per country and day of month
    as HyperLogLog sketches, at most 31 rows a country, whatever the log's
    size. Each map task sends one sketch per day, never its hosts. Rows
    whose day does not parse belong to no day."""
    dated = with_country(logs, countries).withColumn("day", day_of(F.col("timestamp"))) \
        .where(F.col("day").between(1, 31))
    return dated.groupBy("country_code", "day").agg(F.hll_sketch_agg("host", lg_k).alias("sketch"))


def unique_hosts_between(sketches: DataFrame, periods: DataFrame) -> DataFrame:
    """``country_code, from_day, to_day, unique_hosts``: estimated distinct hosts
    of each period (``from_day, to_day``, both included) by uniting the days'
    sketches; the log is not read again. Periods without a host are absent."""
    # periods are the caller's list
    days = periods.withColumn("day", F.explode(F.sequence("from_day", "to_day")))
    return sketches.join(F.broadcast(days), "day").groupBy("country_code", "from_day", "to_day") \
        .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_hosts"))


def exact_hosts_between(logs: DataFrame, periods: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """The same by counting: every host of every period is shuffled."""
    dated = with_country(logs, countries).select("country_code", "host", day_of(F.col("timestamp")).alias("day")).distinct()
    inside = dated.join(F.broadcast(periods), F.col("day").between(F.col("from_day"), F.col("to_day")))
    return inside.groupBy("country_code", "from_day", "to_day").agg(F.count_distinct("host").alias("unique_hosts"))


def checked_unique_hosts(logs: DataFrame, periods: DataFrame, countries: dict[str, str] | None = None,
                         lg_k: int = LG_K) -> DataFrame:
    """Exact distinct hosts of each period with ``within_error``: whether the
    sketches' estimate lies within ``relative_error`` of it (half a host at least)."""
    keys = ["country_code", "from_day", "to_day"]
    estimate = unique_hosts_between(host_sketches(logs, countries, lg_k), periods) \
        .withColumnRenamed("unique_hosts", "estimate")
    bound = F.greatest(F.lit(0.5), F.col("unique_hosts") * relative_error(lg_k))
    return exact_hosts_between(logs, periods, countries).join(estimate, keys, "left") \
        .select(*keys, "unique_hosts",
                F.coalesce(F.abs(F.col("estimate") - F.col("unique_hosts")) <= bound, F.lit(False)).alias("within_error"))


def candidate_buckets(hosts: DataFrame, k: int, probes: int = PROBES) -> DataFrame:
    """``country_code, bucket`` of all buckets that can hold one of a country's
    ``k`` busiest hosts.

    A bucket's total bounds the count of each of its hosts. The hosts of the
    ``k * probes`` largest buckets are counted; the k-th largest of those counts
    is one that a top host reaches, so a bucket with a smaller total holds none.
    With fewer than k hosts found, every bucket stays.
    """
    totals = stored(hosts.groupBy("country_code", "bucket").agg(F.count(F.lit(1)).alias("total")), "bucket-totals")
    largest = top_k(totals, ["country_code"], [F.col("total").desc(), F.col("bucket").asc()], k * probes) \
        .select("country_code", "bucket")
    looked_at = hosts.join(F.broadcast(largest), ["country_code", "bucket"], "left_semi") \
        .groupBy("country_code", "host").agg(F.count(F.lit(1)).alias("n"))
    least = top_k(looked_at, ["country_code"], [F.col("n").desc(), F.col("host").asc()], k) \
        .where(F.col("rank") == k).select("country_code", F.col("n").alias("least"))
    return totals.join(F.broadcast(least), "country_code", "left") \
        .where(F.col("total") >= F.coalesce("least", F.lit(0))).select("country_code", "bucket")


def country_top_hosts(logs: DataFrame, k: int = 9, countries: dict[str, str] | None = None,
                      buckets: int = BUCKETS, probes: int = PROBES) -> DataFrame:
    """``rollup.country_top_hosts``, the same rows, with bounded shuffles: totals
    of ``buckets`` hash buckets a country, then counts of the hosts in candidate
    buckets only. The fewer hosts stand out, the more buckets stay; if none can
    be ruled out all hosts are counted, as the plain rollup does. The log is
    scanned three times. The broadcast has at most ``buckets`` rows a country."""
    countries = countries or COUNTRIES
    hosts = with_country(logs, countries).select(
        "country_code", "host", F.pmod(F.xxhash64("host"), F.lit(buckets)).cast("int").alias("bucket"))
    wanted = stored(candidate_buckets(hosts, k, probes), "candidate-buckets")
    counts = hosts.join(F.broadcast(wanted), ["country_code", "bucket"], "left_semi") \
        .groupBy("country_code", "host").agg(F.count(F.lit(1)).alias("count"))
    ranked = top_k(counts, ["country_code"], [F.col("count").desc(), F.col("host").asc()], k)
    return ranked.join(F.broadcast(country_spine(logs.sparkSession, countries)), "country_code") \
        .select("country_code", "country", "rank", "host", "count")

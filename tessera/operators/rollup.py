"""Per-country request rollups over parsed access logs: counts, unique hosts,
top hosts, shares with a Rest row. Every country is a grouping key in one pass;
nothing is fed back through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.logparse import country_of
from ..session import stored
from .ranking import top_k

# The countries the original analysis reports, by host suffix.
COUNTRIES = {"de": "Germany", "ca": "Canada", "sg": "Singapore"}


def country_spine(spark: SparkSession, countries: dict[str, str] | None = None) -> DataFrame:
    """One row per requested country; its size is the caller's list, not data."""
    countries = countries or COUNTRIES
    return spark.createDataFrame(list(countries.items()), "country_code string, country string")


def with_country(logs: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """Keep rows whose host ends in ``.<code>`` for a requested code; add the code."""
    codes = list((countries or COUNTRIES).keys())
    return logs.withColumn("country_code", country_of(F.col("host"), codes)) \
        .filter(F.col("country_code").isNotNull())


def host_counts(logs: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """Requests per (country, host); map-side partial aggregation collapses hot hosts."""
    return with_country(logs, countries).groupBy("country_code", "host") \
        .agg(F.count(F.lit(1)).alias("count"))


def country_requests(logs: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """Total requests per requested country (0 when none) in one scan."""
    countries = countries or COUNTRIES
    counts = with_country(logs, countries).groupBy("country_code") \
        .agg(F.count(F.lit(1)).alias("requests"))
    spine = country_spine(logs.sparkSession, countries)
    return spine.join(counts, "country_code", "left") \
        .select("country_code", "country", F.coalesce("requests", F.lit(0)).alias("requests"))


def country_unique_hosts(logs: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """Distinct hosts per requested country (exact; hosts deduplicated before the
    country-level merge, so a big country is not one task)."""
    countries = countries or COUNTRIES
    uniq = with_country(logs, countries).groupBy("country_code") \
        .agg(F.count_distinct("host").alias("unique_hosts"))
    spine = country_spine(logs.sparkSession, countries)
    return spine.join(uniq, "country_code", "left") \
        .select("country_code", "country", F.coalesce("unique_hosts", F.lit(0)).alias("unique_hosts"))


def country_top_hosts(logs: DataFrame, k: int = 9, countries: dict[str, str] | None = None) -> DataFrame:
    """k busiest hosts per country, ties broken by host name ascending."""
    countries = countries or COUNTRIES
    ranked = top_k(host_counts(logs, countries), ["country_code"],
                   [F.col("count").desc(), F.col("host").asc()], k)
    names = country_spine(logs.sparkSession, countries)
    return ranked.join(F.broadcast(names), "country_code") \
        .select("country_code", "country", "rank", "host", "count")


def host_share_rest(logs: DataFrame, k: int = 9, countries: dict[str, str] | None = None) -> DataFrame:
    """Top-k hosts per country plus a ``Rest`` row (rank k+1) with every other
    request, each as a percentage of the country's requests.

    Totals come from the same host counts as the ranking. Those counts (a
    row per host, far fewer than requests) are written, so the log is
    scanned once although four branches read them."""
    countries = countries or COUNTRIES
    return shares_from_counts(stored(host_counts(logs, countries), "host-counts"), k, countries)


def counts_from_slots(slots: DataFrame) -> DataFrame:
    """``host_counts`` from the finer ``calendar.host_slots``."""
    return slots.groupBy("country_code", "host").agg(F.sum("n").alias("count"))


def requests_from_counts(counts: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """Requests per requested country from ``host_counts`` (0 when none)."""
    countries = countries or COUNTRIES
    per = counts.groupBy("country_code").agg(F.sum("count").alias("requests"))
    return country_spine(counts.sparkSession, countries).join(per, "country_code", "left") \
        .select("country_code", "country", F.coalesce("requests", F.lit(0)).alias("requests"))


def unique_from_counts(counts: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """Distinct hosts per requested country from ``host_counts`` (a row per host)."""
    countries = countries or COUNTRIES
    per = counts.groupBy("country_code").agg(F.count(F.lit(1)).alias("unique_hosts"))
    return country_spine(counts.sparkSession, countries).join(per, "country_code", "left") \
        .select("country_code", "country", F.coalesce("unique_hosts", F.lit(0)).alias("unique_hosts"))


def shares_from_counts(counts: DataFrame, k: int = 9, countries: dict[str, str] | None = None) -> DataFrame:
    """Top-k shares and the Rest row from ``host_counts``."""
    countries = countries or COUNTRIES
    names = country_spine(counts.sparkSession, countries)
    top = top_k(counts, ["country_code"], [F.col("count").desc(), F.col("host").asc()], k) \
        .select("country_code", "rank", "host", "count")
    totals = counts.groupBy("country_code").agg(F.sum("count").alias("requests"))
    top_sum = top.groupBy("country_code").agg(F.sum("count").alias("top_sum"))
    rest = totals.join(top_sum, "country_code", "left").select(
        "country_code", F.lit(k + 1).alias("rank"), F.lit("Rest").alias("host"),
        (F.col("requests") - F.coalesce("top_sum", F.lit(0))).alias("count"))
    rows = top.unionByName(rest)
    # totals and names have one row per requested country: bounded broadcasts.
    return rows.join(F.broadcast(totals), "country_code").join(F.broadcast(names), "country_code") \
        .select("country_code", "country", "rank", "host", "count",
                F.round(F.col("count") / F.col("requests") * 100.0, 6).alias("percent"))

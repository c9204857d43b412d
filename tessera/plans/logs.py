"""Web access log analysis, from the events table to chart-ready results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.logparse import day_of, hour_of, log_time_of, parse_access_log
from ..operators import calendar, rollup, sketches
from ..operators.ranking import top_k
from ..session import scratch_path, shared, stored
from ..sources.files import read_text_lines, table, write_text_lines
from ..sources.standins import access_log_lines


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The access log as gzip text, the original input format.

    Lines are built from ``events`` once per application and written under
    the shared checkpoint folder (at least one file per core, since a gzip
    file is one split); every log query then scans that text. The write also
    cuts the lineage, so the parser's filters meet a plain ``value`` column
    instead of re-evaluating the line-building expression.
    """
    def write() -> str:
        lines = access_log_lines(table(spark, sf_dir, "events"))
        target = spark.sparkContext.defaultParallelism
        if lines.rdd.getNumPartitions() < target:
            lines = lines.repartition(target)
        path = scratch_path(spark, "access-log")
        write_text_lines(lines, path)
        return path

    path = shared(spark, "access-log", sf_dir, write)
    return read_text_lines(spark, path)


def parsed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines built from ``events`` and parsed back (C1)."""
    return parse_access_log(log_lines(spark, sf_dir))


def log_parse(spark, sf_dir):
    return parsed_log(spark, sf_dir)


def log_preview(spark, sf_dir, n: int = 20):
    """First n parsed rows by log time, then by every column for a stable order."""
    logs = parsed_log(spark, sf_dir)
    return logs.orderBy(log_time_of(F.col("timestamp")).asc_nulls_last(), *logs.columns).limit(n)


def country_preview(spark, sf_dir, n: int = 5):
    """First n parsed rows of each country by log time (then every column)."""
    logs = rollup.with_country(parsed_log(spark, sf_dir))
    order = [log_time_of(F.col("timestamp")).asc_nulls_last()] + \
        [F.col(f"`{c}`").asc() for c in logs.columns if c != "country_code"]
    return top_k(logs, ["country_code"], order, n)


def log_time(spark, sf_dir):
    """Day and hour by position, and the true UTC instant as epoch seconds."""
    logs = parsed_log(spark, sf_dir)
    ts = F.col("timestamp")
    return logs.select("host", "timestamp", day_of(ts).alias("day"), hour_of(ts).alias("hour"),
                       F.unix_seconds(log_time_of(ts)).alias("epoch_utc"))


def country_requests(spark, sf_dir):
    return rollup.country_requests(parsed_log(spark, sf_dir))


def country_unique_hosts(spark, sf_dir):
    return rollup.country_unique_hosts(parsed_log(spark, sf_dir))


def country_top_hosts(spark, sf_dir):
    return rollup.country_top_hosts(parsed_log(spark, sf_dir), 9)


def top_hosts_by_buckets(spark, sf_dir):
    """``country_top_hosts`` without a shuffle of every host."""
    return sketches.country_top_hosts(parsed_log(spark, sf_dir), 9)


def unique_hosts_by_period(spark, sf_dir):
    """Distinct hosts per country of each week of the month, each half and the
    whole, with the check that the daily sketches give them within their error."""
    periods = spark.createDataFrame([(1, 7), (8, 14), (15, 21), (22, 31), (1, 15), (16, 31), (1, 31)],
                                    "from_day int, to_day int")
    return sketches.checked_unique_hosts(parsed_log(spark, sf_dir), periods)


def host_share_rest(spark, sf_dir):
    return rollup.host_share_rest(parsed_log(spark, sf_dir), 9)


def busiest_host_grid(spark, sf_dir):
    return calendar.busiest_host_grid(parsed_log(spark, sf_dir))


def chart_series(spark, sf_dir):
    """Chart-ready tidy rows ``(series, x, y)``: requests and unique hosts by
    country, host shares, and the busiest hosts' day-hour activity, all from one
    written table of counts per (country, host, day, hour): one scan of the log."""
    slots = stored(calendar.host_slots(parsed_log(spark, sf_dir)), "host-slots")
    counts = rollup.counts_from_slots(slots)
    req = rollup.requests_from_counts(counts).select(
        F.lit("requests").alias("series"), F.col("country").alias("x"), F.col("requests").cast("double").alias("y"))
    uniq = rollup.unique_from_counts(counts).select(
        F.lit("unique_hosts").alias("series"), F.col("country").alias("x"),
        F.col("unique_hosts").cast("double").alias("y"))
    share = rollup.shares_from_counts(counts).select(
        F.concat(F.lit("share:"), F.col("country")).alias("series"), F.col("host").alias("x"),
        F.col("percent").alias("y"))
    grid = calendar.grid_from_slots(slots).select(
        F.concat(F.lit("activity:"), F.col("country")).alias("series"),
        F.format_string("%02d-%02d", F.col("day"), F.col("hour")).alias("x"),
        F.col("count").cast("double").alias("y"))
    return req.unionByName(uniq).unionByName(share).unionByName(grid)

"""Dense calendar grids: day x hour activity with zeros filled by a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.logparse import day_of, hour_of
from ..session import stored
from .ranking import top_k
from .rollup import COUNTRIES, country_spine, with_country


def day_hour_spine(keys: DataFrame, days: int = 31, hours: int = 24) -> DataFrame:
    """Every (key row, day 1..days, hour 0..hours-1); size = keys x days x hours."""
    return keys.withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(days)))) \
        .withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(hours - 1))))


def host_slots(logs: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """Requests ``n`` per (country, host, day, hour), day and hour null for
    times that do not parse: at most hosts x 745 rows per country. Day and hour
    are read from the log text by position (the log's own clock)."""
    ts = F.col("timestamp")
    slot_ok = day_of(ts).between(1, 31) & hour_of(ts).between(0, 23)
    return with_country(logs, countries or COUNTRIES).select(
        "country_code", "host",
        F.when(slot_ok, day_of(ts)).alias("day"), F.when(slot_ok, hour_of(ts)).alias("hour")) \
        .groupBy("country_code", "host", "day", "hour").agg(F.count(F.lit(1)).alias("n"))


def grid_from_slots(slots: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """The busiest host of each country on the dense day x hour grid, from
    ``host_slots`` (read twice, so a written table)."""
    countries = countries or COUNTRIES
    totals = slots.groupBy("country_code", "host").agg(F.sum("n").alias("total"))
    busiest = top_k(totals, ["country_code"], [F.col("total").desc(), F.col("host").asc()], 1) \
        .select("country_code", "host")
    # busiest has at most one row per requested country: a bounded broadcast.
    hits = slots.filter(F.col("day").isNotNull()) \
        .join(F.broadcast(busiest), ["country_code", "host"], "left_semi")
    spine = day_hour_spine(busiest.join(F.broadcast(country_spine(slots.sparkSession, countries)),
                                        "country_code"))
    return spine.join(hits, ["country_code", "host", "day", "hour"], "left") \
        .select("country_code", "country", "host", "day", "hour",
                F.coalesce("n", F.lit(0)).alias("count"))


def busiest_host_grid(logs: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """Requests by day of month and hour of the busiest host of each country,
    dense over 31 days x 24 hours with 0 where the host was idle. Host totals,
    the busiest host and the grid all come from the written slot counts, so
    no raw row is read twice."""
    return grid_from_slots(stored(host_slots(logs, countries), "host-slots"), countries)

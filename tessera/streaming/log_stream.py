"""The per-country request rollup over a log folder that keeps receiving files.

The original analysis is batch only; this is the same parser and rollup read
incrementally (Structured Streaming), for logs that arrive as new files.
State is the running count per country, so it stays as small as the list
of countries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.logparse import parse_access_log
from ..operators.rollup import COUNTRIES, with_country
from ..session import scratch_path


def country_requests_stream(spark: SparkSession, log_dir: str,
                            countries: dict[str, str] | None = None,
                            files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of running requests per requested country."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    logs = parse_access_log(reader.load(log_dir))
    return with_country(logs, countries or COUNTRIES).groupBy("country_code") \
        .agg(F.count(F.lit(1)).alias("requests"))


def start_to_memory(stream: DataFrame, name: str, checkpoint: str | None = None) -> StreamingQuery:
    """Run the rollup into an in-process table ``name`` (complete mode); the
    checkpoint goes to the shared folder. A restarted driver resumes only if it
    passes the same ``checkpoint`` again; the default is a fresh folder."""
    spark = stream.sparkSession
    return stream.writeStream.outputMode("complete").format("memory").queryName(name) \
        .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{name}")) \
        .start()

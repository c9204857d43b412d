"""Access-log parsing as column expressions (whole-stage codegen, no Python rows)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns and output column names of the original parser.
HOST_PATTERN = r"^(\S+)"
TIME_PATTERN = r".* - - \[(.*)\].*"
REQUEST_PATTERN = r'.*"(.*)".*'
STATUS_COL = "HTTP reply code"
BYTES_COL = "bytes in the reply"
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"


def host_of(value: Column) -> Column:
    """First run of non-space characters; ``''`` when there is none."""
    return F.regexp_extract(value, HOST_PATTERN, 1)


def time_text_of(value: Column) -> Column:
    """Bracketed time, only when ident and user are both ``-``; else ``''``."""
    return F.regexp_extract(value, TIME_PATTERN, 1)


def request_of(value: Column) -> Column:
    """Text between the last two double quotes (greedy pattern)."""
    return F.regexp_extract(value, REQUEST_PATTERN, 1)


def token_from_end(value: Column, k: int) -> Column:
    """k-th space-separated token from the end, null when the line is shorter."""
    return F.try_element_at(F.split(value, " "), F.lit(-k))


def parse_access_log(lines: DataFrame, value_col: str = "value", drop_bad: bool = True) -> DataFrame:
    """Five columns per line: host, timestamp, request, status, bytes.

    Status and bytes are the last two tokens cast to int and bigint; text that is not a
    number (``-``) becomes null. With ``drop_bad`` rows with any null are
    dropped; unmatched patterns give ``''`` and are kept.
    """
    v = F.col(value_col)
    status = token_from_end(v, 2).try_cast("int")
    size = token_from_end(v, 1).try_cast("bigint")
    if drop_bad:
        # Same rows as dropping any null: the three pattern columns are null
        # only for a null line. Filtering on the casts first keeps the regexes
        # out of the pushed-down predicate, so each runs once per kept row.
        lines = lines.filter(v.isNotNull() & status.isNotNull() & size.isNotNull())
    return lines.select(
        host_of(v).alias("host"),
        time_text_of(v).alias("timestamp"),
        request_of(v).alias("request"),
        status.alias(STATUS_COL),
        size.alias(BYTES_COL),
    )


def day_of(time_text: Column) -> Column:
    """Day of month read by position from ``dd/MMM/yyyy:HH:mm:ss``; log's own clock."""
    return F.substring(time_text, 1, 2).try_cast("int")


def hour_of(time_text: Column) -> Column:
    """Hour read by position (second ``:``-field); log's own clock."""
    return F.try_element_at(F.split(time_text, ":"), F.lit(2)).try_cast("int")


def log_time_of(time_text: Column) -> Column:
    """True instant of the log time (offset applied); null when it does not parse."""
    return F.try_to_timestamp(time_text, F.lit(LOG_TIME_FORMAT))


def country_of(host: Column, codes: list[str]) -> Column:
    """Suffix code of the host when it ends in ``.<code>`` for one of ``codes``,
    else null; of several codes that fit the longest. A code may have several
    parts (``co.uk``). The host is referenced once, so a pushed-down filter does
    not repeat the host pattern per code."""
    suffix = F.regexp_extract(host, r"\.(" + "|".join(re.escape(c) for c in codes) + ")$", 1)
    return F.nullif(suffix, F.lit(""))

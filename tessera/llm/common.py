"""What several operators of this subpackage share: table reads, written
intermediates in the shared folder, hash keys and distributed running sums."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# White space of the text contracts: blank and the controls 0x09 to 0x0D.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

KEY_BITS = 60
ROWS_PER_RANGE = 512
MAX_RANGES = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: its
    readers prune columns, share the work and survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once; lambdas inside ``body``
    may then use it per element without computing it again."""
    return F.get(F.transform(F.array(value), body), 0)


def hash_key(*parts: Column) -> Column:
    """Uniform integer in [0, 2^60) from the text of ``parts`` (null counts as
    empty); the first 15 hex digits of an MD5, so plain SQL can repeat it."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def range_count(rows_in_largest_group: int, rows_per_range: int = ROWS_PER_RANGE) -> int:
    return max(1, min(MAX_RANGES, math.ceil(rows_in_largest_group / rows_per_range)))


def key_range(key: Column, ranges: int) -> Column:
    """Which of ``ranges`` equal slices of the hash space holds the key. Keys
    are uniform, so slices hold about equally many rows, without sampling; a
    pure function of the key, so retried tasks agree."""
    width = -(-(1 << KEY_BITS) // ranges)
    return F.call_function("div", key, F.lit(width)).cast("int")


def running_sums(df: DataFrame, light: DataFrame, group: list[str], key: str, order: list[Column],
                 sums: dict[str, str], extra: DataFrame | None = None,
                 rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Rows of ``df`` with ``<out>`` = sum of column ``sums[out]`` over the rows
    before them in their group, ordered by the hash key and then ``order``.

    ``light`` has the same rows with at least ``group``, ``key`` and the summed
    columns (a written table: it is read twice). Each group is cut into slices
    of the hash space; slices are totalled (one small row each), the totals
    are accumulated per group, and rows are summed inside their slice only, so
    a group with a third of all rows is spread over many tasks. ``extra``, one
    row per group, is attached on the way. ``group`` columns must not be null.
    """
    largest = light.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    n = range_count(largest, rows_per_range)
    per = light.groupBy(*group, key_range(F.col(key), n).cast("int").alias("__range")).agg(
        *[F.sum(v).alias(f"__sum_{out}") for out, v in sums.items()])
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(*group, "__range", *[
        F.coalesce(F.sum(f"__sum_{out}").over(before), F.lit(0)).alias(f"__off_{out}") for out in sums])
    if extra is not None:
        offsets = offsets.join(extra, group)
    rows = df.withColumn("__range", key_range(F.col(key), n).cast("int")).join(offsets, [*group, "__range"])
    inside = Window.partitionBy(*group, "__range").orderBy(key, *order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    added = {out: F.col(f"__off_{out}") + F.coalesce(F.sum(v).over(inside), F.lit(0))
             for out, v in sums.items()}
    return rows.withColumns(added).drop("__range", *[f"__off_{out}" for out in sums])


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until no column of ``taken`` is so called."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name

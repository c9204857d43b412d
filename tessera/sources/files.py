"""Typed readers and writers (text, CSV, parquet) and a scoped persist."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StringType, StructField, StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_text_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per line, column ``value``.

    A gzip file is one split, so a single big log would be read by one task;
    spread the lines round-robin when the scan yields fewer partitions than the
    cluster has cores.
    """
    lines = spark.read.text(path)
    target = min_partitions or spark.sparkContext.defaultParallelism
    if lines.rdd.getNumPartitions() < target:
        lines = lines.repartition(target)
    return lines


def write_text_lines(df: DataFrame, path: str, column: str = "value",
                     compression: str = "gzip") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite") \
        .option("compression", compression).text(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV with a header. Pass a schema: inference costs a full extra pass."""
    reader = spark.read.option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def read_headerless_csv(spark: SparkSession, path: str, names: list[str],
                        dtype: DataType = DoubleType()) -> DataFrame:
    """Headerless CSV typed at the scan: names by position, one type for all."""
    schema = StructType([StructField(n, dtype, True) for n in names])
    return spark.read.option("header", False).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).csv(path)


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename every column by position in one projection."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def cast_strings(df: DataFrame, to: str = "double") -> DataFrame:
    """Cast every string column; text that does not parse becomes null."""
    strings = set(string_columns(df))
    return df.select([F.col(f"`{c}`").try_cast(to).alias(c) if c in strings else F.col(f"`{c}`")
                      for c in df.columns])


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parts(df: DataFrame, part_col: str, path: str) -> None:
    """Write every part of a labelled split in one job, one folder per part."""
    df.write.mode("overwrite").partitionBy(part_col).parquet(path)


def read_part(spark: SparkSession, path: str, part_col: str, part: str) -> DataFrame:
    """One part of a split written by ``write_parts``; the filter prunes folders."""
    return spark.read.parquet(path).filter(F.col(part_col) == part).drop(part_col)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist a reused result for the scope of a block, then release it."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()

"""A training corpus from raw documents, in five stages.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its result is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import line_dedup, mixing, ngram_join, packing, quality
from tessera.llm.common import stored, table

# A near copy shares 0.8 of its text, so what line dedup leaves of it is less than this.
SCRAP = 0.2


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; rows with rejected texts go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_repeated_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that occur earlier in the corpus. A document
    of which less than ``SCRAP`` of its text is left was a copy or near copy of
    earlier ones, and the rest a scrap of it: its row goes. All others stay, also
    those that were empty before."""
    out = line_dedup.line_dedup(docs)
    dedup = F.col(f"`{out.columns[-1]}`")
    scrap = (dedup["removed_lines"] > 0) & (F.char_length(F.coalesce("text", F.lit(""))) < SCRAP * dedup["chars_before"])
    return out.where(~F.coalesce(scrap, F.lit(False))).select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicate texts the row with the smallest id, of
    those the longest text. Rows repeating an id are texts of their own, so none
    goes that is no near duplicate. Texts without words belong to no group: of
    rows with the same id and such text one stays. Rows without an id all stay."""
    rows = docs.where("doc_id is not null").select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # Written once, as the numbers follow the partitions.
    rows = stored(rows.withColumn("number", F.monotonically_increasing_id()), "numbered")
    text = F.coalesce("row.text", F.lit(""))
    light = rows.select("number", F.col("row.doc_id").alias("id"), F.length(text).alias("n"), F.sha2(text, 256).alias("sha"))
    groups = ngram_join.similar_documents(rows.select(F.col("number").alias("doc_id"), "row.text"))
    wordless = F.when(F.col("n_shingles") == 0, F.struct("id", "sha"))
    kept = light.join(groups, light["number"] == groups["doc_id"]) \
        .groupBy(F.when(F.col("n_shingles") > 0, F.col("component_id")), wordless) \
        .agg(F.min(F.struct("id", -F.col("n"), "sha", "number"))["number"].alias("kept")).select("kept")
    rows = rows.join(kept, rows["number"] == kept["kept"], "left_semi").select("row.*")
    return rows.unionByName(docs.where("doc_id is null"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions, repeated or cut to the word."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenized documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_chunks),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mixed_sources),
    ("packing", packed),
]

# Trained scores and similarity groups are not SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

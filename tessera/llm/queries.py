"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, exact_dedup, fill_middle, filter_audit, html_text, license_scan, line_dedup, mixing, ngram_join
from . import packing, quality, sharding, toxicity
from .common import table


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", *[F.col(f"dedup.{c}").cast("bigint").alias(c)
                                          for c in ("n_lines", "removed_lines", "removed_runs")])


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
                       F.sha2("fim.output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(F.col("fim.output"), F.col("fim.form")), 256)
                       .alias("restored_sha256"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))

    def labels(column: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(column)), ",")

    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("bigint").alias("n_base"),
        F.array_min("phrases.start").cast("bigint").alias("first_word"),
        F.array_max("phrases.start").cast("bigint").alias("last_word"),
        labels(F.col("phrases.label")).alias("base_labels"),
        labels(F.concat("phrases.label", "passages.label")).alias("labels"),
        F.coalesce(F.array_max("passages.share"), F.lit(0.0)).alias("score"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_nearest": op1_nearest,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_main_text": op4_main_text,
    "op5_line_dedup": op5_line_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_source_mix": op7_source_mix,
    "op8_ngram_join": op8_ngram_join,
    "op9_quality": op9_quality,
    "op10_rendezvous_shards": op10_rendezvous_shards,
    "op11_fill_middle": op11_fill_middle,
    "op12_license_scan": op12_license_scan,
    "op13_filter_audit": op13_filter_audit,
}

"""Exact duplicates by skew-safe combining of full contents.

Equal texts are brought together in three steps, each grouping by the digest
*and the whole normalised text*, so contents are compared, not only digests:
partial aggregation inside each map task, a merge of (digest, salt) groups,
and a merge of the salt winners. A text that a third of all rows share leaves
each task as one row per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, stored

SALTS = 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", "")


def _winner(length: Column, doc_id: Column) -> Column:
    """Orders rows of a group: most code points, then smallest id (a null id last)."""
    return F.max(F.struct(length.alias("n"), F.bitwise_not(doc_id).alias("inverse")))


def text_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct normalised text: ``digest, norm, keep_id, keep_n,
    group_size``."""
    rows = docs.select(
        F.col("doc_id"), F.char_length(F.coalesce("text", F.lit(""))).alias("n"),
        normalised(F.col("text")).alias("norm"))
    rows = rows.select("doc_id", "n", "norm", F.sha2("norm", 256).alias("digest"),
                       F.pmod(F.xxhash64("doc_id", "n"), F.lit(salts)).cast("int").alias("salt"))
    salted = rows.groupBy("digest", "norm", "salt").agg(
        _winner(F.col("n"), F.col("doc_id")).alias("best"), F.count(F.lit(1)).alias("rows"))
    merged = salted.groupBy("digest", "norm").agg(
        F.max("best").alias("best"), F.sum("rows").alias("group_size"))
    return merged.select("digest", "norm", F.bitwise_not(F.col("best.inverse")).alias("keep_id"),
                         F.col("best.n").alias("keep_n"), "group_size")


def exact_dedup(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """For each row of ``docs`` (``doc_id, text``): ``doc_id, keep_id,
    group_size, kept, text_sha256``.

    Texts are equal when identical without white space; null counts as empty.
    Of equal texts the row with the most code points stays, then the smallest
    doc_id (null ids lose to all others). ``group_size`` counts rows, repeated
    ones too; rows that repeat the id and length of the row that stays are
    marked kept like it. An empty table gives an empty result. Other columns
    are not read.
    """
    groups = text_groups(docs, salts)
    # The text itself is only needed again if one digest has two contents.
    light = stored(groups.select("digest", "keep_id", "keep_n", "group_size",
                                 F.xxhash64("norm", F.lit(1)).alias("second")), "op6-groups")
    clash = light.groupBy("digest").count().where("count > 1").select("digest")
    rows = docs.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("n"),
                       normalised(F.col("text")).alias("norm"))
    rows = rows.select("doc_id", "n", F.sha2("norm", 256).alias("digest"), "norm")
    clashing = not clash.isEmpty()
    # Two plain shuffles meet here, so that skew splitting can cut a hot digest's rows.
    alone = stored(light.join(clash, "digest", "left_anti"), "op6-groups") if clashing else light
    result = rows.drop("norm").join(alone, "digest")
    if clashing:  # two contents under one SHA-256: tell them apart by their text
        by_text = groups.join(clash, "digest", "left_semi")
        result = result.unionByName(
            rows.join(by_text, ["digest", "norm"]).withColumn("second", F.lit(0).cast("bigint")).drop("norm"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n"))
    return result.select("doc_id", "keep_id", "group_size", kept.alias("kept"),
                         F.col("digest").alias("text_sha256"))

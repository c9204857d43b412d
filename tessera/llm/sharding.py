"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Each record scores every shard by a hash of (record key, shard) and goes to
the best one; a new shard only ever takes the records that score it best, so
growing from n to n + 1 shards moves about 1 / (n + 1) of the rows, all of
them into the new shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_key, running_sums, stored

SHARDS = 24


def shard_score(doc_id: Column, shard: int, weight: float) -> Column:
    """Rank of one shard for one record; smaller is better: an exponential
    waiting time with rate ``weight``, from 52 hash bits."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{shard}:"), F.coalesce(doc_id.cast("string"), F.lit("")))),
                              1, 13), 16, 10).cast("bigint")
    unit = (bits.cast("double") + 1.0) / float(1 << 52)
    return -F.log(unit) / F.lit(float(weight))


def rendezvous(doc_id: Column, weights: Sequence[float]) -> Column:
    """Struct of the best ``score`` and its ``shard`` (ties to the smaller)."""
    each = [F.struct(shard_score(doc_id, s, w).alias("score"), F.lit(s).alias("shard"))
            for s, w in enumerate(weights) if w > 0]
    return F.least(*each) if len(each) > 1 else each[0]


def shard_documents(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS,
                    new_weight: float = 1.0) -> DataFrame:
    """For each row of ``docs`` (``doc_id, text``): ``doc_id, size,
    text_crc32, law, shard, slot, grown_shard``.

    ``shard`` depends on doc_id and the shard weights only (law ``key``);
    ``grown_shard`` is the shard with one more shard of ``new_weight``.
    ``size`` is the UTF-8 bytes of the text plus 8, a null text counting as
    empty. ``slot`` numbers each shard's rows from 0 without gaps, by hash key.
    Rows with the same id share a shard, null ids too; repeated rows get a slot
    each. An empty table gives an empty result.
    """
    best = rendezvous(F.col("doc_id"), weights)
    new = shard_score(F.col("doc_id"), len(weights), new_weight)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), best.alias("best"), new.alias("new"),
        hash_key(F.lit("slot"), F.col("doc_id"), text).alias("key"))
    rows = rows.select(
        "doc_id", "size", "text_crc32", F.col("best.shard").alias("shard"),
        F.when(F.col("new") < F.col("best.score"), F.lit(len(weights))).otherwise(F.col("best.shard"))
        .alias("grown_shard"), "key", F.lit(1).alias("one"))
    light = stored(rows, "op10-rows")
    placed = running_sums(light, light, ["shard"], "key", [F.col("doc_id")], {"slot": "one"})
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                         "grown_shard")

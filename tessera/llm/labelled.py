"""What the two classifiers share: the held-out fold and the fitting sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY_BITS, hash_key

FOLDS, HELD_OUT = 4, 2


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 modulo 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def fitting_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """``text, label`` (0 or 1) of labelled documents outside the held-out fold,
    at most about ``max_rows`` of them: those with the smallest hash keys.

    Rows without a label are left out; of several labels for one id the largest
    counts. The labels that remain are bounded by ``max_rows``, so they may be
    broadcast to the documents.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    n = known.count()
    if n > max_rows:
        known = known.where(hash_key(F.lit("fit"), F.col("doc_id")) < int((1 << KEY_BITS) * (max_rows / n)))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "label")

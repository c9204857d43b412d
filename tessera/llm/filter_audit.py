"""What a chain of document filters removes, in every order of the filters.

Each document fails some set of the five filters: a row of a mask matrix, 0
where it fails and infinite where it passes. Each order gives the position of
every filter, the inverse of the permutation: a row of a position matrix. The
min-plus product of both, the minimum over filters of mask plus position, is
the step at which the document goes. Documents with the same mask go at the
same steps, so each part is first counted per mask (at most 32 rows), and the
steps then scatter those counts, weighted, into orders and steps.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, bind

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

# Filters A to D; E is the repetition of a text.
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_UPPER_PERCENT = 10
SYMBOLS = "[#$%&*|]"


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: the text fails A (few words), B (repeated words), C (capitals), D (symbols)."""
    words = F.filter(F.split(text, f"[{SPACE}]+", -1), lambda w: w != "")
    counts = bind(words, lambda w: F.struct(F.size(w).cast("bigint").alias("all"),
                                            F.size(F.array_distinct(w)).cast("bigint").alias("distinct")))
    return bind(counts, lambda n: F.when(n["all"] < MIN_WORDS, 1).otherwise(0)
                + F.when(n["distinct"] * 100 < n["all"] * MIN_DISTINCT_PERCENT, 2).otherwise(0)) \
        + F.when(F.regexp_count(text, F.lit("[A-Z]")).cast("bigint") * 100
                 > F.char_length(text).cast("bigint") * MAX_UPPER_PERCENT, 4).otherwise(0) \
        + F.when(F.rlike(text, F.lit(SYMBOLS)), 8).otherwise(0)


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: how many rows of each part fail exactly
    the filters of ``mask`` (bit 0 is A), and how many of them are labelled.

    Texts leave the first stage as a digest and four bits. Rows with the same
    text, part and labels are one row from then on, also before the shuffle, so
    a text that a third of all rows share is a few rows per task.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), text_mask(text).alias("bits"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
    rows = rows.groupBy("doc_id", "part", "digest", "bits").agg(F.count(F.lit(1)).alias("n")) \
        .join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    # The rows with the smallest id of a text pass E; so do those without an id.
    known = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    groups = rows.groupBy("digest", "bits", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(known).alias("least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("without_id"))
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))  # a few rows per digest by now
    groups = groups.withColumn("first", first)
    passed = F.col("without_id") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    masked = groups.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("bits").alias("mask"), passed.alias("rows")),
        F.struct((F.col("bits") + 16).alias("mask"), (F.col("n") - passed).alias("rows")))))
    return masked.groupBy("part", "mask").agg(
        F.sum("rows").alias("n"), F.sum(F.col("rows") * F.col("good")).alias("good"),
        F.sum(F.col("rows") * F.col("toxic")).alias("toxic"))


def positions() -> np.ndarray:
    """Position of each filter (column) in each order (row): the inverse permutations."""
    orders = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])
    return np.argsort(orders, axis=1)


def removal_steps(masks: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Step (from 0) at which each mask goes in each order, infinite if it
    passes all filters: the min-plus product of masks and positions."""
    fails = (masks[:, None] >> np.arange(len(FILTERS))) & 1
    weights = np.where(fails == 1, 0.0, np.inf)
    return (weights[:, None, :] + position[None, :, :]).min(axis=2)


def _audit(part: pd.DataFrame) -> pd.DataFrame:
    """One part's rows for every order and step from its (at most 32) masks."""
    size = len(FILTERS)
    position = positions()
    orders = np.argsort(position, axis=1)  # the filter at each step
    masks = part["mask"].to_numpy()
    steps = removal_steps(masks, position)
    counts = part[["n", "good", "toxic"]].to_numpy(dtype=np.int64)
    row, order = np.nonzero(np.isfinite(steps))
    at = (order, steps[row, order].astype(int))
    lost = np.zeros((3, len(ORDERS), size), dtype=np.int64)
    for k in range(3):
        np.add.at(lost[k], at, counts[row, k])
    removed = lost[0]
    failing = np.array([counts[(masks >> f) & 1 == 1, 0].sum() for f in range(size)])
    only = np.array([counts[masks == 1 << f, 0].sum() for f in range(size)])
    shapley = np.zeros(size, dtype=np.int64)
    np.add.at(shapley, orders.ravel(), removed.ravel())
    values = [counts[:, 0].sum() - removed.cumsum(axis=1), removed, failing[orders] - removed, only[orders],
              lost[1], lost[2], shapley[orders]]
    return pd.DataFrame({
        "part": part["part"].iloc[0], "filter_order": np.repeat(ORDERS, size),
        "step": np.tile(np.arange(1, size + 1, dtype=np.int32), len(ORDERS)),
        **{c: v.ravel() for c, v in zip(COUNTS, values, strict=True)}})


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each part (``lang`` of ``docs``; null: empty string), order of the
    filters and step: ``part, filter_order, step`` and the counts of documents
    ``kept`` after the step, ``removed`` at it, ``redundant`` (they fail its
    filter but went earlier), ``unique_fails`` (they fail no other),
    ``good_lost`` and ``toxic_lost`` (removed here and so labelled in ``labels``)
    and ``shapley`` (what its filter removes, over all orders).

    A null text counts as empty: it fails A and, if its text stands at a
    smaller id, E. Rows that repeat an id count each and do not make each other
    fail E; rows without an id neither fail E nor make others fail it. Null
    labels are no labels; of several for one id each mark that occurs counts. Texts
    are equal when their SHA-256 is. An empty table gives no rows. Other columns
    are not read.
    """
    return mask_counts(docs, labels).groupBy("part").applyInPandas(
        _audit, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))

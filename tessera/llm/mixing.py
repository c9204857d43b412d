"""Mixing sources to target weights.

Every document gets a hash-random key. Within each source documents are
ordered by key in slices of the hash space, word counts are accumulated by
distributed prefix sums, and the source is cut at its exact word budget. A
source whose budget exceeds its size is repeated in whole epochs first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, hash_key, running_sums, stored

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``src, src_null, source_size, target``.

    Sources in code-point order (null last) weigh ``weights``, repeating. The
    words of all sources are shared by weight; a target stops at ``max_epochs``
    times its source's size and the excess is reshared until none is above.
    With sources sorted by cap per weight, those below the final water level
    come first, so the level is a closed form over running sums. The two
    windows see one row per source.
    """
    by_source = sized.groupBy("src", "src_null").agg(F.sum("size").alias("source_size"))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     (F.row_number().over(Window.orderBy("src_null", "src")) - 1) % len(weights) + 1)
    capped = by_source.withColumn("w", w).withColumn("cap", F.col("source_size") * max_epochs) \
        .withColumn("ratio", F.col("cap") / F.col("w"))
    order = Window.orderBy("ratio", "src_null", "src")
    everything = Window.partitionBy()
    level = capped.select(
        "*",
        (F.sum("source_size").over(everything)
         - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .alias("left"),
        F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("w_left"))
    level = level.withColumn("level", F.col("left") / F.col("w_left"))
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "src_null", "src", "level"))) \
        .over(everything)["level"]
    return level.withColumn("final", first).select(
        "src", "src_null", "source_size",
        F.least(F.col("cap").cast("double"), F.col("final") * F.col("w")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = "mix", carry: bool = False) -> DataFrame:
    """For each row of ``docs`` (``doc_id, text, source``): ``doc_id, source,
    size, source_size, target, taken``, and the whole row as struct ``row`` if
    ``carry``.

    ``size`` is the number of words, ``taken`` how many of them the mix takes,
    repeats counted: every epoch takes the document whole, and the last,
    partial epoch takes documents in key order up to the exact budget, the one
    at the cut in part. A null or blank text has size 0 and takes 0. A null
    source is a source of its own, the last. Repeated rows count as often as
    they occur. An empty table gives an empty result. The key depends on seed,
    doc_id and text only, so reruns agree.
    """
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row.doc_id").alias("doc_id"),
        F.coalesce("row.source", F.lit("")).alias("src"),
        F.col("row.source").isNull().cast("int").alias("src_null"),
        F.regexp_count(F.coalesce("row.text", F.lit("")), F.lit(WORD)).cast("bigint").alias("size"),
        hash_key(F.lit(seed), F.col("row.doc_id"), F.col("row.text")).alias("key"))
    light = stored(rows.drop("row"), "op7-sizes")
    placed = running_sums(
        rows if carry else light, light, ["src", "src_null"], "key",
        [F.col("doc_id"), F.col("size")], {"before": "size"},
        extra=source_targets(light, weights, max_epochs))
    budget = F.floor("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.call_function("div", budget, F.col("source_size"))) \
        .otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.select(
        "doc_id", F.when(F.col("src_null") == 0, F.col("src")).alias("source"), "size", "source_size",
        "target", (epochs * F.col("size") + part).alias("taken"), *(["row"] if carry else []))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS,
                    max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixed corpus itself, with the columns of ``docs``: each document as
    often as the mix takes it, the one at a source's cut shortened to the words
    taken (white space between them as it was). ``n_chars``, if present, follows
    the text. Documents without words take no part."""
    taken = mix(docs, weights, max_epochs, carry=True).where("taken > 0")
    whole = F.call_function("div", F.col("taken"), F.col("size")).cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    copies = taken.select(
        "row", F.explode(F.concat(F.array_repeat(F.lit(0), whole),
                                  F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>"))))
        .alias("cut"))
    pieces = F.split(F.col("row.text"), f"(?<=[^{SPACE}])(?=[{SPACE}])")
    text = F.when(F.col("cut") == 0, F.col("row.text")) \
        .otherwise(F.array_join(F.slice(pieces, F.lit(1), F.col("cut")), ""))
    copies = copies.select("row", text.alias("cut_text"))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("cut_text").alias(c))
        elif c == "n_chars":
            out.append(F.char_length("cut_text").cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(f"row.`{c}`").alias(c))
    return copies.select(*out)

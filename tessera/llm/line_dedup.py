"""Repeated runs of lines, deduplicated over the whole corpus.

Lines are cut into content-defined chunks: a rolling hash runs over the hashes
of neighbouring lines and opens a chunk where its first digit is small, so the
same run of lines is cut the same way wherever it stands (an inserted line
shifts the following boundaries only until the next one). Chunks of two or more
lines are grouped by their bytes; all but the first go.

A repeated passage rarely begins and ends with a boundary, and a short one may
hold none. So the chunks that went are then extended, and short passages found,
pair by pair: of the neighbouring lines that do not lie inside such a chunk,
each two that stand together at an earlier place (SHA-256 of both) go too. A
pair's first place never lies inside a chunk that went, as that chunk stood
earlier still; so in the end a run of lines goes if and only if each two of its
neighbouring lines stand at an earlier place, whatever stands around it, and
the chunks only keep most lines out of the pair index.

Runs with little in them, such as closing brackets or blank lines, stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bind, free_name, stored

# A line opens a chunk when the first hex digit of the rolling hash is below
# this: one line in four, for chunks of four lines on average.
OPENS_BELOW = "4"
# Distinct words a repeated run must hold to go.
MIN_DISTINCT_WORDS = 5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _rolling(lines: Column) -> Column:
    """MD5(hash(line i) + hash(line i+1)) of each two neighbouring lines."""
    def pairs(hashed: Column) -> Column:
        inner = F.size(hashed) - 1
        return F.zip_with(F.slice(hashed, F.lit(1), inner), F.slice(hashed, F.lit(2), inner),
                          lambda a, b: F.md5(F.concat(a, b)))

    return bind(F.transform(lines, lambda x: F.md5(x)), pairs)


def line_chunks(lines: Column, opens_below: str = OPENS_BELOW) -> Column:
    """The chunks of an array of lines as structs ``start`` (1-based) and ``n``."""
    starts = F.transform(_rolling(lines), lambda x, i: F.when(F.substring(x, 1, 1) < opens_below, i + 2).otherwise(0))
    return bind(F.array_remove(starts, 0), lambda inner: F.zip_with(
        F.concat(F.array(F.lit(1)), inner), F.concat(inner, F.array(F.size(lines) + 1)),
        lambda a, b: F.struct(a.alias("start"), (b - a).alias("n"))))


def _joined(lines: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(lines, start, n), "\n")


def _all_but_first(places: DataFrame, keys: list[str]) -> DataFrame:
    """The ``places`` (``doc_id, ident, start`` and the keys) that are not the
    first one with their keys. Keys that occur once are dropped first."""
    place = F.struct("doc_id", "ident", "start")
    repeated = places.groupBy(*keys).agg(F.min(place).alias("first"), F.max(place).alias("last")) \
        .where("first != last").select(*keys, "first")
    return places.join(stored(repeated, "op5-repeated"), keys).where(~place.eqNullSafe(F.col("first")))


def _repeated_chunks(rows: DataFrame, opens_below: str) -> DataFrame:
    """``id, chunks``: the chunks (``start, n``) of each row that went, by bytes."""
    chunked = rows.select("id", F.explode(bind(_lines(F.col("row.text")), lambda lines: F.transform(
        F.filter(line_chunks(lines, opens_below), lambda c: c["n"] > 1),
        lambda c: F.struct(c["start"].alias("start"), c["n"].alias("n"),
                           _joined(lines, c["start"], c["n"]).alias("body"))))).alias("c"))
    chunked = chunked.select("id.*", "c.*")
    place = F.struct("doc_id", "ident", "start")
    # Grouping by the body compares the bytes; partial aggregation sends a
    # chunk that thousands of documents share once per task.
    hashes = [F.md5("body").alias("digest"), F.xxhash64("body").alias("check")]
    repeated = chunked.groupBy("body").agg(F.min(place).alias("first"), F.max(place).alias("last")) \
        .where("first != last").select(*hashes, "first")
    places = chunked.select("doc_id", "ident", "start", "n", *hashes)
    gone = places.join(stored(repeated, "op5-chunks"), ["digest", "check"]).where(~place.eqNullSafe(F.col("first")))
    return gone.groupBy(F.struct("doc_id", "ident").alias("id")).agg(
        F.collect_set(F.struct("start", "n")).alias("chunks"))


def _inner_pairs(chunks: Column) -> Column:
    """First lines of the neighbouring lines inside the chunks."""
    return F.flatten(F.transform(chunks, lambda c: F.sequence(c["start"], c["start"] + c["n"] - 2)))


def _repeated_pairs(rows: DataFrame) -> DataFrame:
    """``id, pairs``: the first lines of the pairs outside ``chunks`` that stand at
    an earlier place."""
    def pairs(lines: Column) -> Column:
        every = F.when(F.size(lines) > 1, F.sequence(F.lit(1), F.size(lines) - 1)).otherwise(
            F.array().cast("array<int>"))
        outside = F.when(F.col("chunks").isNull(), every).otherwise(F.array_except(every, _inner_pairs(F.col("chunks"))))
        return F.transform(outside, lambda i: F.struct(
            i.alias("start"), F.unhex(F.sha2(_joined(lines, i, F.lit(2)), 256)).alias("digest")))

    places = rows.select("id", F.explode(bind(_lines(F.col("row.text")), pairs)).alias("p")).select("id.*", "p.*")
    return _all_but_first(places, ["digest"]).groupBy(F.struct("doc_id", "ident").alias("id")) \
        .agg(F.collect_set("start").alias("pairs"))


def _runs(lines: Column, pairs: Column, min_words: int) -> Column:
    """Runs of lines (``start``, ``n``) that successive ``pairs`` (ascending) span,
    those of ``min_words`` or more distinct words."""
    def joined(p: Column) -> Column:
        starts = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) != x - 1))
        ends = F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) != x + 1))
        return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a + 2).alias("n")))

    def n_words(run: Column) -> Column:
        words = F.split(_joined(lines, run["start"], run["n"]), f"[{SPACE}]+", -1)
        return F.size(F.array_remove(F.array_distinct(words), ""))

    return F.filter(bind(pairs, joined), lambda run: n_words(run) >= min_words)


def line_dedup(docs: DataFrame, min_words: int = MIN_DISTINCT_WORDS, opens_below: str = OPENS_BELOW) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text`` and any others) with repeated runs
    of lines taken out of ``text``, plus a struct ``dedup`` of ``n_lines,
    removed_lines, removed_runs, chars_before`` (code points of the text as it was).

    A run of two or more lines goes if each two neighbouring lines of it stand
    at an earlier place (smaller doc_id, null first, or earlier in the document)
    and it holds at least ``min_words`` distinct words. ``opens_below`` cuts the
    chunks and does not change the result. Identical rows (same id and text)
    count as one document: what stays in one stays in all. A null text counts
    as empty and stays null; a text whose lines all go becomes empty. Single
    lines are never removed. An empty table gives an empty result.
    """
    ident = F.xxhash64(F.coalesce("row.text", F.lit("")))
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.withColumn("id", F.struct(F.col("row.doc_id").alias("doc_id"), ident.alias("ident")))
    marked = stored(rows.join(_repeated_chunks(rows, opens_below), "id", "left"), "op5-rows")
    marked = marked.join(_repeated_pairs(marked), "id", "left")
    none = F.array().cast("array<int>")
    went = F.array_sort(F.array_union(F.coalesce("pairs", none), F.coalesce(_inner_pairs(F.col("chunks")), none)))
    untouched = F.col("chunks").isNull() & F.col("pairs").isNull()
    runs = F.when(untouched, F.array().cast("array<struct<start:int,n:int>>")).otherwise(
        bind(_lines(F.col("row.text")), lambda lines: _runs(lines, went, min_words)))
    out = marked.select("row", F.size(_lines(F.col("row.text"))).alias("n_lines"), runs.alias("runs"))
    gone = F.flatten(F.transform("runs", lambda r: F.sequence(r["start"], r["start"] + r["n"] - 1)))
    left = bind(_lines(F.col("row.text")), lambda lines: F.transform(
        F.array_except(F.sequence(F.lit(1), F.size(lines)), gone), lambda i: F.get(lines, i - 1)))
    out = out.select(
        "row", F.when(F.size("runs") == 0, F.col("row.text")).otherwise(F.array_join(left, "\n")).alias("text"),
        F.struct("n_lines", F.aggregate("runs", F.lit(0), lambda n, r: n + r["n"]).alias("removed_lines"),
                 F.size("runs").alias("removed_runs"), F.char_length("row.text").alias("chars_before")).alias("dedup"))
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.col("text").alias(c))
        elif c == "n_chars":
            cols.append(F.char_length("text").cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(f"row.`{c}`").alias(c))
    return out.select(*cols, F.col("dedup").alias(free_name("dedup", docs.columns)))

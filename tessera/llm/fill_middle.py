"""Fill-in-the-middle: documents cut at two line boundaries and rearranged.

The cut ranks count lines, the cuts are made in code points. Each document's
lines form an indexable skip list: a boundary between two lines is a node, its
height comes from hash bits of its rank, and every link of every express lane
carries how many lines and how many code points it passes. Walking the links
from the highest lane down, while the lines passed stay within the rank, ends
on the boundary itself with its code-point offset accumulated, in a number of
steps logarithmic in the lines.

Only line widths go to the Python workers and only two offsets per document
come back; texts are cut and joined by built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .arrays import mix64
from .common import bind, free_name

PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM_RATE = 7, 100, 50
LANE_BITS = 2  # one node in four of a lane also stands in the lane above


class SkipList:
    """Boundaries of units of the given widths, found by rank.

    ``lanes[0]`` links every boundary to the next. A lane is three lists, one
    entry per node: the units and the width its link passes, and the place of
    the same node in the lane below.
    """

    def __init__(self, widths: Sequence[int]):
        width = np.asarray(widths, dtype=np.int64)
        units = np.ones(len(width), dtype=np.int64)
        rank = np.arange(len(width), dtype=np.int64)
        self.lanes = [(units.tolist(), width.tolist(), rank.tolist())]
        bits = mix64(rank.astype(np.uint64))
        while len(rank) > 1:
            tall = bits & np.uint64((1 << LANE_BITS) - 1) == 0
            tall[0] = True  # the head stands in every lane
            at = np.flatnonzero(tall)
            if len(at) == len(rank):
                break
            units, width = np.add.reduceat(units, at), np.add.reduceat(width, at)
            rank, bits = rank[at], bits[at] >> np.uint64(LANE_BITS)
            self.lanes.append((units.tolist(), width.tolist(), at.tolist()))

    def offset(self, rank: int) -> int:
        """Width of the first ``rank`` units."""
        passed = offset = node = 0
        for units, width, below in reversed(self.lanes):
            while node < len(units) and passed + units[node] <= rank:
                passed += units[node]
                offset += width[node]
                node += 1
            if node == len(units):  # at the end: every unit is passed
                break
            node = below[node]
        return offset


def line_widths(text: Column) -> Column:
    """Code points of each line, its line feed included; what follows the last
    line feed is a line if it is not empty."""
    parts = F.transform(F.split(text, "\n", -1), lambda part: F.char_length(part))
    # The last part has no line feed, and is no line if it is empty.
    return bind(parts, lambda n: F.concat(
        F.transform(F.slice(n, F.lit(1), F.size(n) - 1), lambda chars: chars + 1),
        F.filter(F.slice(n, F.size(n), F.lit(1)), lambda chars: chars > 0)))


@F.pandas_udf(StructType([StructField("first", LongType()), StructField("second", LongType())]))
def cut_offsets(widths: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
    """Code-point offsets of two boundaries given by rank."""
    found = []
    for lines, a, b in zip(widths, first, second, strict=True):
        lanes = SkipList(lines)
        found.append((lanes.offset(a), lanes.offset(b)))
    return pd.DataFrame(found, columns=["first", "second"], dtype="int64")


def _hashes(doc_id: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text`` and any others) with a struct
    ``fim`` of ``n`` (lines), ``form`` (``plain``, ``psm`` or ``spm``), ``output``
    and the code points ``prefix_chars, middle_chars`` (null if plain).

    ``rate`` per cent of the documents are rearranged, ``spm_rate`` per cent of
    those with the suffix first; ranks and forms follow from a hash of the id,
    so reruns and repeated ids agree. A null text counts as empty; empty texts
    and texts that spell a sentinel stay plain, and their output is the text. A
    null id hashes as the empty string. One line of any length is a line; the
    cuts may coincide, then the middle is empty. An empty table gives an empty
    result. The struct is renamed if ``docs`` has a column of its name.
    """
    h1, h2, h3, h4 = _hashes(F.col("row.doc_id"), seed)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", text.alias("text"), line_widths(text).alias("widths"), h1.alias("h1"), h2.alias("h2"),
        h3.alias("h3"), h4.alias("h4"))
    n = F.size("widths")
    spells = F.lit(False)
    for sentinel in SENTINELS:
        spells = spells | F.contains("text", F.lit(sentinel))
    plain = (n == 0) | spells | (F.col("h3") % 100 >= rate)
    rows = rows.select(
        "row", "text", n.cast("bigint").alias("n"),
        F.when(plain, F.lit("plain")).when(F.col("h4") % 100 < spm_rate, F.lit("spm")).otherwise(F.lit("psm"))
        .alias("form"),
        cut_offsets("widths", F.least(F.col("h1") % (n + 1), F.col("h2") % (n + 1)),
                    F.greatest(F.col("h1") % (n + 1), F.col("h2") % (n + 1))).alias("cut"))
    a, b = F.col("cut.first").cast("int"), F.col("cut.second").cast("int")
    prefix, middle = F.substring("text", F.lit(1), a), F.substring("text", a + 1, b - a)
    suffix = F.substring("text", b + 1, F.char_length("text"))
    p, s, m = (F.lit(sentinel) for sentinel in SENTINELS)
    is_plain = F.col("form") == "plain"
    output = F.when(is_plain, F.col("text")) \
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)) \
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
    fim = F.struct("n", "form", output.alias("output"),
                   F.when(~is_plain, F.col("cut.first")).alias("prefix_chars"),
                   F.when(~is_plain, F.col("cut.second") - F.col("cut.first")).alias("middle_chars"))
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns],
                       fim.alias(free_name("fim", docs.columns)))


def restored(output: Column, form: Column) -> Column:
    """The text back from an output and its form. Texts that spell a sentinel
    are plain, so each sentinel stands once."""
    p, s, m = (F.instr(output, sentinel) for sentinel in SENTINELS)
    size = len(PREFIX)

    def between(start: Column, end: Column) -> Column:
        return F.substring(output, start + size, end - start - size)

    middle = F.substring(output, m + size, F.char_length(output))
    return F.when(form == "plain", output) \
        .when(form == "psm", F.concat(between(p, s), middle, between(s, m))) \
        .otherwise(F.concat(between(p, m), middle, between(s, p)))

"""Set difference that moves only the rows that can matter.

``subtract`` and ``exceptAll`` shuffle both tables on every column. Here only
a 64-bit digest of each row is shuffled first. Digests that both sides hold are
put into a bit field of bounded size, which is broadcast: a row whose bit is
not set has no equal on the other side and passes (or goes) where it is. The
others are compared on all columns, so equal digests of different rows and
shared bits cost time, never a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

BITS_PER_DIGEST = 16
MIN_BITS, MAX_BITS = 1 << 15, 1 << 28  # the largest field is 32 MB
FIELD = 1 << 15  # bits of one row of the field, as Spark's bitmap functions have it


def row_digest(columns: list[Column]) -> Column:
    """64-bit hash of a row; a null leaves a trace of its place."""
    return F.xxhash64(*[x for c in columns for x in (c, c.isNull())])


def _aligned(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the left one's names and the types a union would have, by position."""
    both = left.limit(0).union(right.limit(0)).schema
    sides = [side.toDF(*[f"_c{i}" for i in range(len(both))]) for side in (left, right)]
    return tuple(side.select(*[F.col(f"_c{i}").cast(f.dataType).alias(f"_c{i}") for i, f in enumerate(both)])
                 for side in sides)


def _bit(number: Column) -> Column:
    """Whether bit ``number`` of its field row is set; no row, no bit."""
    place = F.bitmap_bit_position(number).cast("int")
    byte = F.conv(F.hex(F.substring("_field", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, F.pmod(place, F.lit(8))).bitwiseAND(1) == 1, F.lit(False))


def digest_difference(left: DataFrame, right: DataFrame, keep_duplicates: bool = False,
                      digest: Callable[[list[Column]], Column] = row_digest, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``left`` that are not in ``right``: distinct rows (EXCEPT), or,
    with ``keep_duplicates``, each row as often as it stands more in ``left``
    (EXCEPT ALL). Nulls equal nulls; columns go by position, names are the left
    one's. Both inputs are read twice. An empty side is fine.

    Only rows whose digest both sides hold, and for EXCEPT those that repeat in
    ``left``, are shuffled whole. ``max_bits`` bounds the broadcast field; a
    smaller field sends more rows to the comparison.
    """
    names = left.columns
    a, b = _aligned(left, right)
    cols = [F.col(c) for c in a.columns]
    held = a.select(digest(cols).alias("d"), F.lit(1).alias("l"), F.lit(0).alias("r")) \
        .unionByName(b.select(digest(cols).alias("d"), F.lit(0).alias("l"), F.lit(1).alias("r"))) \
        .groupBy("d").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    meets = (F.col("l") > 0) & (F.col("r") > 0)
    met = stored(held.where(meets if keep_duplicates else meets | (F.col("l") > 1)).select("d"), "digests-met")
    wanted = max(1, met.count()) * BITS_PER_DIGEST
    bits = max(MIN_BITS, min(max_bits, 1 << math.ceil(math.log2(wanted))))
    number = F.pmod(F.col("d"), F.lit(bits))
    field = met.select(number.alias("n")).groupBy(F.bitmap_bucket_number("n").alias("_bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("_field"))
    field = F.broadcast(field)  # at most bits / 8 bytes

    def marked(side: DataFrame) -> DataFrame:
        n = F.pmod(digest(cols), F.lit(bits))
        numbered = side.withColumn("_n", n).withColumn("_bucket", F.bitmap_bucket_number("_n"))
        return numbered.join(field, "_bucket", "left").withColumn("_met", _bit(F.col("_n")))

    ours = marked(a)
    rest, others = ours.where("_met").select(*a.columns), marked(b).where("_met").select(*a.columns)
    rest = rest.exceptAll(others) if keep_duplicates else rest.subtract(others)
    return ours.where("not _met").select(*a.columns).union(rest).toDF(*names)

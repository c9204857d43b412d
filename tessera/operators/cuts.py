"""Exact cuts of an ordered table by quantile sketches.

A split at 40, 60 or 80 % of the rows needs three values of the order, not a
rank of every row. A mergeable quantile sketch brackets each of them, counts
say exactly on which side of the bracket's pivots it lies, and only the few
rows left in the bracket are put in order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WAIT_ROWS = 20_000
STEPS = 16  # pivots per bracket and round


@dataclass
class Cut:
    """Rows up to and with ``value`` (None: only nulls, if any) are the first
    ``rows`` of ``total``."""

    fraction: float
    value: int | None
    rows: int
    total: int


def _inside(key: str, lo: int, hi: int) -> Column:
    return F.col(key).between(F.lit(lo), F.lit(hi))


def rank_cuts(df: DataFrame, key: str, fractions: list[float], wait_rows: int = WAIT_ROWS) -> list[Cut]:
    """For each fraction, the largest ``key`` whose ``percent_rank`` is below
    it, and how many rows that takes, exactly.

    ``key`` is a whole number; nulls come first, ties share a rank, and a table
    of one row has rank 0, as in ``percent_rank``. Each round is two scans of
    the key for all fractions together: one sketch per bracket, then counts
    below its pivots. A bracket ends when it holds at most ``wait_rows`` rows
    or a single value, so a value that a third of all rows share ends it too.
    What the driver sees are sketch quantiles and counts, STEPS per fraction.
    """
    k = F.col(key).cast("bigint")
    rows = df.select(k.alias("k"))
    total, nulls, low, high = rows.agg(F.count(F.lit(1)), F.count_if(F.col("k").isNull()), F.min("k"), F.max("k")).first()

    def below(before: int, fraction: float) -> bool:
        return (before / (total - 1) if total > 1 else 0.0) < fraction

    done, open_ = {}, {}
    for f in fractions:
        if not total or not below(0, f):
            done[f] = Cut(f, None, 0, total)
        elif low is None or not below(nulls, f):
            done[f] = Cut(f, None, nulls, total)
        else:  # lo, hi, rows before lo, rows inside
            open_[f] = (low, high, nulls, total - nulls)
    while any(size > wait_rows and lo < hi for lo, hi, _, size in open_.values()):
        active = {f: b for f, b in open_.items() if b[3] > wait_rows and b[0] < b[1]}
        sketches = rows.agg(*[F.kll_sketch_agg_bigint(F.when(_inside("k", lo, hi), F.col("k"))).alias(f"s{i}")
                              for i, (lo, hi, _, _) in enumerate(active.values())])
        found = sketches.select(*[F.kll_sketch_get_quantile_bigint(
            f"s{i}", F.array(*[F.lit(q) for q in _points(f, total, b)])).alias(f"q{i}")
            for i, (f, b) in enumerate(active.items())]).first()
        # The middle of the values is a pivot too: a bracket at least halves.
        pivots = {f: sorted({p for p in [*found[i], (lo + hi) // 2 + 1] if lo < p <= hi})
                  for i, (f, (lo, hi, _, _)) in enumerate(active.items())}
        counts = rows.agg(*[F.count_if(_inside("k", active[f][0], p - 1)).alias(f"n{i}_{j}")
                            for i, f in enumerate(active) for j, p in enumerate(pivots[f])]).first()
        for i, (f, (lo, hi, before, size)) in enumerate(active.items()):
            at = {p: counts[f"n{i}_{j}"] for j, p in enumerate(pivots[f])}
            yes = [p for p, n in at.items() if below(before + n, f)]
            no = [p for p, n in at.items() if not below(before + n, f)]
            start, end = (max(yes), at[max(yes)]) if yes else (lo, 0), (min(no) - 1, at[min(no)]) if no else (hi, size)
            open_[f] = (start[0], end[0], before + start[1], end[1] - start[1])
    for f, (lo, hi, before, _) in open_.items():
        values = rows.where(_inside("k", lo, hi)).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.orderBy("k")) + before  # at most wait_rows rows, or one
        last = values.withColumn("upto", upto) \
            .where((((F.col("upto") - F.col("n")) / F.lit(max(total - 1, 1))) < f) | F.lit(total == 1)) \
            .orderBy(F.desc("k")).first()
        done[f] = Cut(f, last.k, last.upto, total) if last else Cut(f, None, before, total)
    return [done[f] for f in fractions]


def _points(fraction: float, total: int, bracket: tuple[int, int, int, int]) -> list[float]:
    """Quantiles of a bracket close around the place where the cut must lie."""
    _, _, before, size = bracket
    middle = min(1.0, max(0.0, (fraction * (total - 1) - before) / size))
    return sorted({min(1.0, max(0.0, middle + side * 0.04 * step / STEPS))
                   for side in (-1, 1) for step in range(1, STEPS // 2 + 1)} | {middle})


def cut_sizes(df: DataFrame, cuts: list[Cut]) -> DataFrame:
    """``fraction, train_rows, test_rows``, one row per cut."""
    return df.sparkSession.createDataFrame([(float(c.fraction), c.rows, c.total - c.rows) for c in cuts],
                                           "fraction double, train_rows long, test_rows long")


def first_part(key: Column, cut: Cut) -> Column:
    """Condition: the row belongs to the part before the cut. A plain comparison
    with a constant, so it reaches the scan."""
    if cut.value is None:
        return key.isNull() if cut.rows else F.lit(False)
    return key.isNull() | (key <= F.lit(cut.value))

"""Toxicity by a factorization machine over hashed terms.

Terms are a document's words and their first 4, 5 and 6 letters, hashed into a
fixed number of slots. Slots whose presence goes with the label are kept; a
factorization machine learns a weight per slot and a short vector per slot
whose inner products weigh pairs (an insult beside a group mention), which an
additive model misses. Fitted on a bounded sample of labelled rows; every
whole text is scored by tasks that hold only the selected slots.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import U64, Block, blocks, is_class, mix64, span_hashes
from .common import stored
from .labelled import fitting_rows, is_held_out

SLOT_BITS = 20
PREFIXES = (4, 5, 6)
MAX_FIT_ROWS = 12_000
MAX_TERMS = 2048
FACTORS = 4
MIN_Z = 3.0
THRESHOLD = 0.3


def term_slots(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document index, slot) of every term of a block of texts."""
    block = Block(texts, lower=True)
    starts, ends = block.spans(is_class(block.cp, "alpha"))
    doc = block.doc_of(starts)
    docs, slots = [doc], [span_hashes(block.cp, starts, ends)]
    for k in PREFIXES:
        longer = ends - starts > k
        s = starts[longer]
        docs.append(doc[longer])
        slots.append(mix64(span_hashes(block.cp, s, s + k) + U64(k)))
    return np.concatenate(docs), (np.concatenate(slots) >> U64(64 - SLOT_BITS)).astype(np.int64)


def distinct_terms(texts: list[str], lookup: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, slot) pairs in document order; with ``lookup``, slots
    are mapped to selected term numbers and others (-1) left out."""
    doc, slot = term_slots(texts)
    if lookup is not None:
        slot = lookup[slot]
        doc, slot = doc[slot >= 0], slot[slot >= 0]
    key = np.unique((doc << SLOT_BITS) | slot)
    return key >> SLOT_BITS, key & ((1 << SLOT_BITS) - 1)


@dataclass
class FactorizationMachine:
    slots: np.ndarray  # selected slots
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def lookup(self) -> np.ndarray:
        table = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
        table[self.slots] = np.arange(len(self.slots))
        return table

    def margins(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        linear = np.bincount(doc, self.weights[term], n)
        pairs = np.zeros(n)
        for f in range(self.factors.shape[1]):
            v = self.factors[term, f]
            pairs += np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n)
        return self.bias + linear + 0.5 * pairs

    def score(self, texts, table: np.ndarray) -> np.ndarray:
        out = []
        for _, part in blocks(texts):
            doc, term = distinct_terms(part, table)
            out.append(1.0 / (1.0 + np.exp(-np.clip(self.margins(doc, term, len(part)), -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def fit_machine(rows: list[np.ndarray], y: np.ndarray, slots: np.ndarray, epochs: int = 40,
                rate: float = 0.05, l2: float = 1e-3, seed: int = 7) -> FactorizationMachine:
    """Minibatch Adam on the logistic loss; ``rows`` hold term numbers."""
    rng = np.random.default_rng(seed)
    m, n = len(slots), len(rows)
    base = float(np.clip(y.mean() if n else 0.5, 0.01, 0.99))
    model = FactorizationMachine(slots, float(np.log(base / (1 - base))), np.zeros(m),
                                 rng.normal(0, 0.01, (m, FACTORS)))
    if n == 0 or m == 0 or y.min() == y.max():
        return model
    state = [np.zeros((m, 1 + FACTORS)) for _ in range(2)]
    bias_state, step = [0.0, 0.0], 0
    size = max(16, min(256, n // 8))
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, size):
            pick = order[at:at + size]
            term = np.concatenate([rows[i] for i in pick])
            doc = np.repeat(np.arange(len(pick)), [len(rows[i]) for i in pick])
            p = 1.0 / (1.0 + np.exp(-np.clip(model.margins(doc, term, len(pick)), -30, 30)))
            g = (p - y[pick]) / len(pick)
            grad = np.empty((m, 1 + FACTORS))
            grad[:, 0] = np.bincount(term, g[doc], m) + l2 * model.weights / len(pick)
            for f in range(FACTORS):
                v = model.factors[term, f]
                rest = np.bincount(doc, v, len(pick))[doc] - v
                grad[:, 1 + f] = np.bincount(term, g[doc] * rest, m) + l2 * model.factors[:, f] / len(pick)
            step += 1
            state[0] = 0.9 * state[0] + 0.1 * grad
            state[1] = 0.999 * state[1] + 0.001 * grad * grad
            move = rate * (state[0] / (1 - 0.9 ** step)) / (np.sqrt(state[1] / (1 - 0.999 ** step)) + 1e-8)
            model.weights -= move[:, 0]
            model.factors -= move[:, 1:]
            b = g.sum()
            bias_state = [0.9 * bias_state[0] + 0.1 * b, 0.999 * bias_state[1] + 0.001 * b * b]
            model.bias -= rate * (bias_state[0] / (1 - 0.9 ** step)) / (np.sqrt(bias_state[1] / (1 - 0.999 ** step)) + 1e-8)
    return model


def _row_terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at, part in blocks(frame["text"]):
            doc, slot = distinct_terms(part)
            cuts = np.searchsorted(doc, np.arange(1, len(part)))
            yield pd.DataFrame({"label": frame["label"].iloc[at:at + len(part)].to_numpy(),
                                "slots": np.split(slot.astype(np.int32), cuts)})


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic",
        max_fit_rows: int = MAX_FIT_ROWS, max_terms: int = MAX_TERMS) -> FactorizationMachine:
    """Term counts by label are summed in Spark over the fitting rows; only the
    ``max_terms`` best slots and the rows' selected terms reach the driver."""
    rows = stored(fitting_rows(docs, labels, label, max_fit_rows)
                  .mapInPandas(_row_terms, "label int, slots array<int>"), "op2-terms")
    n, pos = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if n == 0:
        return fit_machine([], np.zeros(0), np.zeros(0, dtype=np.int64))
    counts = rows.select("label", F.explode("slots").alias("slot")).groupBy("slot") \
        .agg(F.sum("label").alias("hit"), F.count(F.lit(1)).alias("df")).where("df >= 3")
    # Signed root of the 2 x 2 chi-square between presence and label.
    z = (F.col("hit") - F.col("df") * (pos / n)) / F.sqrt(
        F.col("df") * (pos / n) * (1 - pos / n) * (1 - F.col("df") / (n + 1)) + 1e-9)
    best = counts.withColumn("z", F.abs(z)).where(F.col("z") >= MIN_Z) \
        .orderBy(F.desc("z"), "slot").limit(max_terms)
    slots = np.sort(np.array([r.slot for r in best.select("slot").collect()], dtype=np.int64))
    chosen = F.array(*[F.lit(int(s)) for s in slots]) if len(slots) else F.array().cast("array<int>")
    kept = rows.select("label", F.array_intersect("slots", chosen).alias("slots")).collect()
    kept.sort(key=lambda r: (r.label, sorted(r.slots)))
    terms = [np.searchsorted(slots, np.array(sorted(r.slots), dtype=np.int64)) for r in kept]
    return fit_machine(terms, np.array([r.label for r in kept], dtype=float), slots)


def scorer(model: FactorizationMachine) -> Column:
    """Column function: score of a text column, by Arrow batches."""
    @F.pandas_udf("double")
    def toxic_score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = model.lookup()
        for texts in batches:
            yield pd.Series(model.score(texts, table), dtype="float64")

    return toxic_score


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """For each row of ``docs`` (``doc_id, text``): ``doc_id, held_out, score,
    predicted``.

    Learns from ``labels`` (``doc_id, toxic``) outside the held-out fold only;
    a null label is no label. A null or empty text has no terms and gets the
    score of the bias. Repeated rows are scored each; with no labels, or one
    class only, every score is the base rate. Other columns are not read.
    """
    score = scorer(fit(docs, labels))
    return docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"),
                       score(F.col("text")).alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
